"""Family records in the line-oriented SOFT text format.

``^ENTITY = id`` opens an entity, ``!Entity_key = value`` is metadata,
``!..._table_begin`` to ``!..._table_end`` enclose a tab-separated table whose first row
names its columns.  A record is read in its order, so one file is one unit of
work; many files are many tasks.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.session import ship

META = "path string, gse_id string, entity string, entity_id string, key string, ord int, value string"
CELLS = "path string, gse_id string, entity string, entity_id string, row_ord long, column string, value string"


def _lines(content: bytes) -> Iterator[str]:
    text = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
    for line in text.split(b"\n"):
        yield line.decode("utf-8", "replace").rstrip("\r")


def _events(content: bytes) -> Iterator[tuple]:
    """('meta', entity, id, key, value) and ('row', entity, id, row number, column, value) in file order."""
    entity, entity_id, header, row = "", "", None, 0
    for line in _lines(content):
        if line.startswith("^"):
            entity, _, entity_id = line[1:].partition("=")
            entity, entity_id, header = entity.strip().upper(), entity_id.strip(), None
        elif line.startswith("!"):
            key, _, value = line[1:].partition("=")
            key = key.strip()
            if key.lower().endswith("_table_begin"):
                header, row = [], 0
            elif key.lower().endswith("_table_end"):
                header = None
            else:
                prefix = f"{entity}_"
                yield "meta", entity, entity_id, key[len(prefix) :] if key.upper().startswith(prefix) else key, value.strip()
        elif header == []:
            header = line.split("\t")
        elif header and line:
            for column, value in zip(header, line.split("\t"), strict=False):
                yield "row", entity, entity_id, row, column, value
            row += 1


def _files(spark: SparkSession, path: str) -> DataFrame:
    ship(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(path, gse_id, entity, entity_id, key, ord, value): one row per value, in order within its key."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                rows, seen, series = [], {}, None
                for kind, *event in _events(content):
                    if kind != "meta":
                        continue
                    entity, entity_id, key, value = event
                    series = entity_id if entity == "SERIES" else series
                    seen[(entity_id, key)] = seen.get((entity_id, key), -1) + 1
                    rows.append((file, series, entity, entity_id, key, seen[(entity_id, key)], value))
                frame = pd.DataFrame(rows, columns=[c.split()[0] for c in META.split(", ")])
                frame["gse_id"] = series
                yield frame

    return _files(spark, path).mapInPandas(parse, META)


def read_tables(spark: SparkSession, path: str, entity: str = "SAMPLE") -> DataFrame:
    """(path, gse_id, entity, entity_id, row_ord, column, value): the cells of all tables of one kind of entity, in parts of bounded size."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in CELLS.split(", ")]
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                rows, series = [], None
                for kind, *event in _events(content):
                    if kind == "meta":
                        series = event[1] if event[0] == "SERIES" else series
                    elif event[0] == entity:
                        rows.append((file, series, *event))
                        if len(rows) >= 50_000:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                yield pd.DataFrame(rows, columns=names)

    return _files(spark, path).mapInPandas(parse, CELLS)


def probe_cells(tables: DataFrame) -> DataFrame:
    """(cohort_id, sample_id, feature_id, value) of sample tables: ID_REF and VALUE of samples that have both; no number is null."""
    wide = tables.groupBy("gse_id", "entity_id", "row_ord").agg(F.max(F.when(F.col("column") == "ID_REF", F.col("value"))).alias("id_ref"), F.max(F.when(F.col("column") == "VALUE", F.col("value"))).alias("v"), F.bool_or(F.col("column") == "VALUE").alias("has"))
    return wide.where("id_ref is not null and has").select(F.col("gse_id").alias("cohort_id"), F.col("entity_id").alias("sample_id"), F.col("id_ref").alias("feature_id"), F.col("v").try_cast("double").alias("value"))


def supplementary_urls(metadata: DataFrame) -> DataFrame:
    """Distinct (gse_id, url) of series and samples; NONE and blanks left out, ftp as https."""
    rows = metadata.where(F.col("entity").isin("SERIES", "SAMPLE") & F.col("key").startswith("supplementary_file") & ~F.upper(F.trim("value")).isin("", "NONE"))
    return rows.select("gse_id", F.regexp_replace(F.trim("value"), "^ftp://", "https://").alias("url")).distinct()


def scan_files(metadata: DataFrame) -> DataFrame:
    """(sample_id, url): the first raw scan of each sample."""
    rows = metadata.where((F.col("entity") == "SAMPLE") & F.col("key").startswith("supplementary_file") & F.lower("value").rlike(r"\.cel(\.gz)?$"))
    return rows.groupBy(F.col("entity_id").alias("sample_id")).agg(F.min_by("value", F.struct("key", "ord")).alias("url"))


def series_relations(metadata: DataFrame) -> DataFrame:
    """(parent, child) of 'SuperSeries of' relations."""
    return metadata.where((F.col("key") == "relation") & F.col("value").startswith("SuperSeries of:")).select(F.col("gse_id").alias("parent"), F.trim(F.regexp_replace("value", "^SuperSeries of:", "")).alias("child")).distinct()


def sample_characteristics(metadata: DataFrame, channel: int = 1) -> DataFrame:
    """(gse_id, gsm_id, lines): the characteristic lines of each sample in order."""
    rows = metadata.where((F.col("entity") == "SAMPLE") & (F.col("key") == f"characteristics_ch{channel}"))
    return rows.groupBy("gse_id", F.col("entity_id").alias("gsm_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "value"))), lambda x: x["value"]).alias("lines"))
