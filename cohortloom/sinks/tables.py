"""Tables by cohort: rewriting a cohort leaves the others, a master only grows, a cache is made once, an export is text.

A table is a folder of Parquet on storage that all executors share, partitioned by a key.
Raw files are never written over: what is made of them is a table of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A table, or None where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def write_cohorts(df: DataFrame, path: str, key: str = "gse_id") -> None:
    """Write the rows of some cohorts: theirs are replaced, those of all others stay.

    Rows without a key lie in the partition of null.  Rows are brought together by key and a
    hash of the row, so that a cohort that holds a large part of them is written by several tasks.
    """
    spread = df.withColumn("__part", F.pmod(F.xxhash64(*df.columns), F.lit(8))).repartition(key, "__part").drop("__part")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def append_new(df: DataFrame, path: str, key: str = "gse_id") -> None:
    """Append the cohorts that a master table doesn't hold yet; run again it appends nothing."""
    master = read_or_none(df.sparkSession, path)
    new = df if master is None else df.join(master.select(F.col(key).cast(df.schema[key].dataType)).distinct(), key, "left_anti")
    new.write.mode("append").partitionBy(key).parquet(path)


def write_facts(df: DataFrame, path: str, columns: list[str], key: str = "gse_id") -> None:
    """Side facts of cohorts (channel roles, notes of quality, parent markers): only rows that tell something, each cohort's replaced."""
    told = df.where(F.coalesce(*[F.nullif(F.col(c).cast("string"), F.lit("")) for c in columns]).isNotNull())
    write_cohorts(told, path, key)


def write_harmonized(cohorts: DataFrame, samples: DataFrame, path: str) -> None:
    """The cohort table always, the sample table only where it has rows."""
    cohorts.write.mode("overwrite").parquet(f"{path}/cohorts")
    if not samples.isEmpty():
        write_cohorts(samples, f"{path}/samples")


def cached(spark: SparkSession, path: str, schema: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table that is built and written once; later reads take it as it was written, with its types as told."""
    if read_or_none(spark, path) is None:
        build().select([F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")]).write.mode("errorifexists").parquet(path)
    return spark.read.schema(schema).parquet(path)


def export_text(df: DataFrame, path: str) -> None:
    """A table as packed tab-separated text with a header, its lists joined by ';'."""
    flat = [F.array_join(F.col(f"`{c}`"), ";").alias(c) if t.startswith("array") else F.col(f"`{c}`").cast("string").alias(c) for c, t in df.dtypes]
    df.select(flat).write.mode("overwrite").option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)


def wrong_checksums(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """(file, wanted, found) of source files whose sha256 isn't that of the manifest (file, sha256); found is null for a missing one.

    A file must fit an executor, as it is hashed whole.
    """
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.sha2("content", 256).alias("found"))
    return manifest.select("file", F.lower("sha256").alias("wanted")).join(files, "file", "left").where("found is null or found <> wanted")
