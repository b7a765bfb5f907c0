"""Where plans come from: files or rules; nothing is asked over a network."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.classify import assay_type
from cohortloom.functions.clinical import species_class
from cohortloom.plans.schemas import ColumnCluster, ColumnMappingPlan, QueryFilters, cluster_plan, column_plan

# Diagnoses of the default vocabulary.
DIAGNOSES = "DLBCL follicular_lymphoma mantle_cell_lymphoma CLL_SLL marginal_zone_lymphoma hodgkin_lymphoma multiple_myeloma ALL AML MDS other_lymphoma other_leukemia solid_tumor normal_control".split()


class PlanProvider(Protocol):
    """The interface of a source of plans."""

    def query_filters(self, text: str) -> QueryFilters: ...

    def column_plan(self, cohort: str) -> ColumnMappingPlan | None: ...

    def clusters(self) -> list[ColumnCluster]: ...


def plan_key(payload: dict) -> str:
    """The key under which a plan is kept: a hash of what it was made from."""
    return hashlib.sha256(json.dumps(payload, sort_keys=True).encode()).hexdigest()


class FilePlans:
    """Plans as JSON files of a folder: columns-<cohort>.json and clusters.json; an absent or broken file is no plan."""

    def __init__(self, folder: str):
        self.folder = folder

    def _read(self, name: str) -> str | None:
        try:
            with open(os.path.join(self.folder, name), encoding="utf-8") as file:
                text = file.read()
            json.loads(text)
            return text
        except (OSError, ValueError):
            return None

    def query_filters(self, text: str) -> QueryFilters:
        return rule_filters(text)

    def column_plan(self, cohort: str) -> ColumnMappingPlan | None:
        text = self._read(f"columns-{cohort}.json")
        return column_plan(text) if text else None

    def clusters(self) -> list[ColumnCluster]:
        text = self._read("clusters.json")
        return cluster_plan(text) if text else []


def rule_filters(text: str, diagnoses: list[str] = DIAGNOSES) -> QueryFilters:
    """Filters read from a question by rules: a diagnosis of the vocabulary, species, assay, least number of samples."""
    low = text.lower()
    known = next((d for d in diagnoses if re.search(rf"\b{re.escape(d.lower().replace('_', ' '))}\b", low.replace("_", " "))), None)
    species = "human" if re.search(r"\bhumans?\b|homo sapiens", low) else "mouse" if re.search(r"\bmouse|mice|murine\b", low) else None
    assay = "scrnaseq" if re.search(r"single.?cell", low) else "bulk_rnaseq" if "rna-seq" in low or "rnaseq" in low else "microarray" if "array" in low else None
    least = re.search(r"(?:at least|min(?:imum)?(?: of)?|>=?)\s*(\d+)\s*samples?", low)
    return QueryFilters(known, [known.replace("_", " ")] if known and "_" in known else [], species, assay, int(least[1]) if least else None)


# Words of a text that tell a class of a series, in the order they are tried.
SAMPLE_TYPES = [("mixed", r"(?i)(biops|resect|patient).*cell.?line|cell.?line.*(biops|resect|patient)"), ("cell_line", r"(?i)cell.?line"), ("biopsy", r"(?i)biops|resect|surgical|patient sample|tumou?r tissue")]
TISSUE_CLASSES = [("blood", r"(?i)\bblood\b|pbmc|leuk[oa]c|leukemi|leukaemi|plasma|serum"), ("tissue", r"(?i)tissue|biops|tumou?r|carcinoma|node|ffpe")]
SELECTION_METHODS = [("LCM", r"(?i)microdissect|\blcm\b"), ("FACS_sorting", r"(?i)\bfacs\b|flow.?sort|fluorescence.activated"), ("MACS_sorting", r"(?i)\bmacs\b|magnetic.(?:bead|activated)|bead.select")]


def _told(text: Column, rules: list[tuple[str, str]], otherwise: str) -> Column:
    out = F.when(text.rlike(rules[0][1]), rules[0][0])
    for name, pattern in rules[1:]:
        out = out.when(text.rlike(pattern), name)
    return out.otherwise(otherwise)


def rule_classes(title: Column, summary: Column, organism: Column, technology: Column, diagnosis: str, synonyms: list[str] | None = None) -> Column:
    """The default answer of a row classifier: a struct of the eight fields of a classified series.

    matches_diagnosis, diagnosis_detail (the wanted terms that the text names), species,
    sample_type, tissue_class, assay_type, selection_method and notes; what the text doesn't
    tell is 'unknown', and notes says which fields that are.
    """
    text = F.concat_ws(" ", title, summary)
    low = F.lower(text)
    terms = [t for t in dict.fromkeys([diagnosis, *(synonyms or [])]) if t]
    named = F.array_join(F.array_compact(F.array(*[F.when(low.contains(t.lower()), F.lit(t)) for t in terms])), "; ") if terms else F.lit("")
    assay = F.when(technology.isNull() & (assay_type(technology, title) == "other"), _told(text, [("scrnaseq", r"(?i)single.?(?:cell|nucle)"), ("bulk_rnaseq", r"(?i)rna.?seq"), ("microarray", r"(?i)micro.?array")], "unknown")).otherwise(assay_type(technology, title))
    fields = {
        "species": species_class(organism), "sample_type": _told(text, SAMPLE_TYPES, "unknown"), "tissue_class": _told(text, TISSUE_CLASSES, "unknown"),
        "assay_type": assay, "selection_method": _told(text, SELECTION_METHODS, "unknown"),
    }
    unsure = F.array_join(F.array_compact(F.array(*[F.when(v == "unknown", F.lit(k)) for k, v in fields.items()])), ", ")
    notes = F.when(unsure == "", "").otherwise(F.concat(F.lit("not told: "), unsure))
    matched = low.contains(diagnosis.lower()) if not synonyms else named != ""
    return F.struct(matched.alias("matches_diagnosis"), named.alias("diagnosis_detail"), *[v.alias(k) for k, v in fields.items()], notes.alias("notes"))


def seed_hints(context: str, concepts: dict[str, dict[str, list[str]]] | None = None) -> list[str]:
    """What is known of the concepts of the diagnoses that a context names, a sentence each."""
    low = context.strip().lower()
    if low in ("", "unknown"):
        return []
    wanted = {d: fields for d, fields in (CONCEPTS if concepts is None else concepts).items() if d.lower() in low or d.strip().lower().replace("_", " ") in low}
    return [f"{d}: {name} is one of {', '.join(values)}" for d, fields in wanted.items() for name, values in fields.items()]


# Concepts of some diagnoses and their values.
CONCEPTS = {
    "DLBCL": {"COO": ["GCB", "ABC", "Unclassified"]},
    "CLL_SLL": {"IGHV_status": ["mutated", "unmutated"]},
    "mantle_cell_lymphoma": {"IGHV_status": ["mutated", "unmutated"]},
    "breast_cancer": {"PAM50": ["Luminal A", "Luminal B", "HER2-enriched", "Basal-like", "Normal-like"]},
}


def loaded(name: str, default: object, variable: str = "COHORTLOOM_VOCABULARY") -> object:
    """A vocabulary (diagnoses, aliases, concepts): the JSON file of its name in the folder the variable names, else the default."""
    folder = os.environ.get(variable)
    if not folder or not os.path.exists(os.path.join(folder, f"{name}.json")):
        return default
    with open(os.path.join(folder, f"{name}.json"), encoding="utf-8") as file:
        return json.load(file)


def answered(groups: DataFrame, answer: Callable[[DataFrame], DataFrame], key: str = "fingerprint_id", known: DataFrame | None = None) -> DataFrame:
    """Answers of a provider for distinct groups: only keys without a kept answer are asked, once each.

    ``answer`` maps a frame of groups to (key, fields); a failure of one group is for it to tell in a
    column of its own (``error``), so that it costs no other group.
    """
    distinct = groups.dropDuplicates([key])
    if known is None:
        return answer(distinct)
    return known.join(distinct.select(key), key, "left_semi").unionByName(answer(distinct.join(known.select(key), key, "left_anti")), allowMissingColumns=True)
