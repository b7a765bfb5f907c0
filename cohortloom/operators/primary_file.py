"""Which of a cohort's files is its expression matrix: by name, then by content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import classify as C
from cohortloom.functions.clinical import column_key
from cohortloom.operators.report import ranked_first

#: A matrix has so many rows at least; so many candidates of a cohort are opened at most.
MIN_ROWS, MOST_CANDIDATES = 1000, 5


def primary_by_name(files: DataFrame, cohort: str = "cohort_id", name: str = "name", order: str = "ord") -> DataFrame:
    """(cohort_id, name, unit): of the matrix candidates that name a unit, the one of the first unit, ties in order."""
    unit = C.quantity_unit(F.col(name))
    named = files.where(C.matrix_candidate(F.col(name)) & (unit["unit"] != "unknown"))
    return ranked_first(named.select(cohort, name, unit["unit"].alias("unit"), unit["rank"].alias("__rank"), F.col(order).alias("__ord")), [cohort], [F.col("__rank"), F.col("__ord")]).select(cohort, name, "unit")


def verified_columns(n_rows, columns):
    """The number of sample columns of a table that can be a matrix, else null: rows enough and no genomic table."""
    keys = F.transform(columns, column_key)
    return F.when((n_rows >= MIN_ROWS) & ~C.genomic_table(keys), F.size(columns) - 1)


def primary_by_content(files: DataFrame, samples: DataFrame) -> DataFrame:
    """(cohort_id, verdict, names): the file whose columns fit the number of samples, or all parts that fit it together.

    ``files`` (cohort_id, name, ord, n_rows, columns), ``samples`` (cohort_id, n_samples).
    verdict is single, multi_part or none; cohorts with more than five candidates
    aren't opened (none).
    """
    candidates = files.where(C.matrix_candidate(F.col("name"))).withColumn("n_columns", verified_columns(F.col("n_rows"), F.col("columns")))
    judged = candidates.join(samples, "cohort_id").withColumn("fits", F.coalesce(C.sample_count_fits(F.col("n_columns"), F.col("n_samples")), F.lit(False)))
    facts = judged.groupBy("cohort_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("n_columns").alias("n_tables"),
        F.count_if("fits").alias("n_fit"),
        F.min(F.when(F.col("fits"), F.struct("ord", "name"))).alias("first"),
        F.sum("n_columns").alias("all_columns"),
        F.max("n_samples").alias("n_samples"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("n_columns").isNotNull(), F.struct("ord", "name")))), lambda x: x["name"]), ";").alias("parts"),
    )
    open_ = F.col("n") <= MOST_CANDIDATES
    single = open_ & (F.col("n_fit") == 1)
    parts = open_ & ~single & (F.col("n_tables") > 1) & F.coalesce(C.sample_count_fits(F.col("all_columns"), F.col("n_samples")), F.lit(False))
    verdict = F.when(single, "single").when(parts, "multi_part").otherwise("none")
    return facts.select("cohort_id", verdict.alias("verdict"), F.when(single, F.col("first.name")).when(parts, F.col("parts")).otherwise("").alias("names"))
