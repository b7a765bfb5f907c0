"""End-to-end verbs: search, question, harmonize, finalize. Each is one job over all cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators import harmonize as H
from cohortloom.operators import report as R
from cohortloom.operators.finalize import finalize_report, finalized
from cohortloom.plans.providers import PlanProvider, rule_classes
from cohortloom.plans.schemas import ColumnCluster


def search(catalog: DataFrame, title: str | None = None, description: str | None = None, organism: str | None = None, samples: DataFrame | None = None, properties: list[tuple[str, str]] | None = None, max_results: int = 100) -> DataFrame:
    """A search report: catalog hits, kept where every sample property matches a sample."""
    hits = catalog.where(R.catalog_predicate(title, description, organism)).orderBy("gse_id").limit(max_results)
    if properties and samples is not None:
        found = H.property_counts(samples.join(hits.select("gse_id"), "gse_id", "left_semi"), properties).withColumnRenamed("matches", "property_matches")
        hits = hits.join(found, "gse_id")
    return R.report_rows(hits)


def parse_property(text: str) -> tuple[str, str]:
    """(key, value) of 'key:value', in lower case."""
    key, colon, value = text.partition(":")
    if not colon:
        raise ValueError(f"a sample property is key:value, not {text!r}")
    return key.strip().lower(), value.strip().lower()


def ask(catalog: DataFrame, text: str, plans: PlanProvider) -> DataFrame:
    """A report of a question in words: recall by diagnosis and species, each row with its classes; nothing recalled is dropped."""
    filters = plans.query_filters(text)
    terms = [t for t in [filters.diagnosis, *filters.diagnosis_synonyms] if t]
    organism = {"human": "homo sapiens", "mouse": "mus musculus"}.get(filters.species or "")
    hits = catalog.where(R.recall_predicate(terms, organism))
    technology = F.col("technology") if "technology" in catalog.columns else F.lit(None).cast("string")
    classes = rule_classes(F.col("title"), F.col("summary"), F.col("organism"), technology, terms[-1] if terms else "", terms)
    enough = F.lit(None).cast("boolean") if filters.min_samples is None else F.col("n_samples") >= filters.min_samples
    return hits.withColumn("classes", classes).select("*", "classes.*", enough.alias("meets_min_samples")).drop("classes")


def escalated(df: DataFrame, first: dict[str, str], second: dict[str, str], least: int = 2) -> DataFrame:
    """Answers of a first classifier, replaced by a second's where at least ``least`` of them are 'unknown'.

    ``first`` and ``second`` map each field to the column that holds its answer.
    """
    unknown = sum((F.coalesce(F.col(c), F.lit("unknown")) == "unknown").cast("int") for c in first.values())
    return df.select(*[c for c in df.columns if c not in {*first.values(), *second.values()}], *[F.when(unknown >= least, F.coalesce(F.col(second[f]), F.col(first[f]))).otherwise(F.col(first[f])).alias(f) for f in first])


def harmonize(cohorts: list[DataFrame], clusters: list[ColumnCluster] | None = None, parents: DataFrame | None = None, master: DataFrame | None = None) -> DataFrame:
    """One annotation table of many: names aliased, tables united, columns clustered, cohorts already in the master skipped, parents removed."""
    united = H.union_all([H.aliased(c) for c in cohorts])
    if master is not None:
        united = united.join(H.not_in_master(united.select("gse_id").distinct(), master), "gse_id", "left_semi")
    out = H.clustered(united, clusters or [])
    out = H.union_all([master, out]) if master is not None else out
    return H.without_parents(out, parents) if parents is not None else out


def finalize(cells: DataFrame, units: DataFrame, symbols: DataFrame, lengths: DataFrame, clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(final cells, report) of RNA-seq matrices."""
    return finalized(cells, units, symbols, lengths, clean), finalize_report(cells, units, symbols, lengths, clean)
