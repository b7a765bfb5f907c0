"""RNA-seq matrices of all cohorts finalized in one job: linear scale, symbols, TPM, clean genes, a million, log scale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators import matrix as M
from cohortloom.session import cut_lineage

#: Units that need TPM; others are scaled by length already.
NEEDS_TPM = ["count", "cpm"]


def finalized(cells: DataFrame, units: DataFrame, symbols: DataFrame, lengths: DataFrame, clean: DataFrame) -> DataFrame:
    """Final cells (cohort_id, feature_id, sample_id, value) of every cohort with a known unit (cohort_id, unit).

    ``cells`` are read twice and should be written; the cells by symbol and those scaled to a
    million are written here, as each is read twice.
    """
    linear = M.linear_scale(cells).drop("was_log2")
    named = cut_lineage(M.symbol_sums(linear, symbols).join(units.where("unit is not null"), "cohort_id"))
    counted = M.tpm(named.where(F.col("unit").isin(NEEDS_TPM)).drop("unit"), lengths)
    scaled = counted.unionByName(named.where(~F.col("unit").isin(NEEDS_TPM)).select("cohort_id", "feature_id", "sample_id", "value"))
    million = cut_lineage(M.per_million(M.restricted(scaled, clean)))
    return M.rounded(M.log2_where_linear(million))


def finalize_report(cells: DataFrame, units: DataFrame, symbols: DataFrame, lengths: DataFrame, clean: DataFrame) -> DataFrame:
    """(cohort_id, status, reason, n_features, n_samples, was_log2): processed, skipped or failed for every cohort of ``units``."""
    facts = M.scale_facts(cells).select("cohort_id", "needs_log2", "n_negative")
    known = M.clean_cells(cells).join(symbols.where("symbol is not null").select("feature_id").distinct(), "feature_id", "left_semi").groupBy("cohort_id").agg(F.count_distinct("feature_id").alias("n_known"))
    final = finalized(cells, units, symbols, lengths, clean).groupBy("cohort_id").agg(F.count_distinct("feature_id").alias("n_features"), F.count_distinct("sample_id").alias("n_samples"))
    rows = units.join(facts, "cohort_id", "left").join(known, "cohort_id", "left").join(final, "cohort_id", "left")
    reason = (
        F.when(F.col("needs_log2").isNull(), "no expression matrix")
        .when(F.col("unit").isNull(), "unit unknown")
        .when(F.col("n_negative") > 0, "negative values")
        .when(F.col("n_known").isNull(), "no recognizable identifiers")
        .when(F.col("n_features").isNull(), "no clean genes")
    )
    status = F.when(reason.isNull(), "processed").when(F.col("n_known").isNull() & F.col("needs_log2").isNotNull() & F.col("unit").isNotNull(), "failed").otherwise("skipped")
    return rows.select("cohort_id", status.alias("status"), F.coalesce(reason, F.lit("")).alias("reason"), F.coalesce("n_features", F.lit(0)).alias("n_features"), F.coalesce("n_samples", F.lit(0)).alias("n_samples"), (~F.col("needs_log2")).alias("was_log2"))
