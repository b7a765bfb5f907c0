"""Plans: structured inputs that say what the deterministic operators shall do."""

from __future__ import annotations

import json
from dataclasses import dataclass, field


@dataclass(frozen=True)
class SurvivalMapping:
    """One kind of survival: its time column with unit, its event column with the meaning of its values."""

    survival_type: str
    time_column: str | None = None
    time_unit: str | None = None
    event_column: str | None = None
    event_value_meaning: str | None = None


@dataclass(frozen=True)
class ColumnMappingPlan:
    """Which columns of one cohort hold treatment, response and survival."""

    redundant_columns: list[str] = field(default_factory=list)
    treatment_columns: list[str] = field(default_factory=list)
    treatment_detail_columns: list[str] = field(default_factory=list)
    response_column: str | None = None
    survival: list[SurvivalMapping] = field(default_factory=list)
    notes: str = ""


@dataclass(frozen=True)
class ColumnCluster:
    """Columns of several cohorts that mean the same, with the values to be unified."""

    canonical_name: str
    source_columns: list[str]
    value_mapping: dict[str, str] = field(default_factory=dict)
    notes: str = ""


@dataclass(frozen=True)
class QueryFilters:
    """What a question in words asks for."""

    diagnosis: str | None = None
    diagnosis_synonyms: list[str] = field(default_factory=list)
    species: str | None = None
    assay_type: str | None = None
    min_samples: int | None = None


def column_plan(text: str) -> ColumnMappingPlan:
    """A column plan from JSON; unknown keys are ignored."""
    raw = json.loads(text)
    survival = [SurvivalMapping(**{k: v for k, v in s.items() if k in SurvivalMapping.__dataclass_fields__}) for s in raw.pop("survival", None) or []]
    return ColumnMappingPlan(**{k: v for k, v in raw.items() if k in ColumnMappingPlan.__dataclass_fields__ and v is not None}, survival=survival)


def cluster_plan(text: str) -> list[ColumnCluster]:
    """Clusters from JSON."""
    return [ColumnCluster(**{k: v for k, v in c.items() if k in ColumnCluster.__dataclass_fields__ and v is not None}) for c in json.loads(text).get("clusters", [])]
