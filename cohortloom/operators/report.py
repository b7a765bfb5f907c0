"""Search results and cohort reports."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Columns of a search report, and those shown only if any row has them.
REPORT_COLUMNS = ["gse_id", "title", "summary", "organism", "platforms", "n_samples", "submission_date", "pubmed_ids"]
OPTIONAL_COLUMNS = ["property_matches", "array_content", "classification", "notes"]


def catalog_predicate(title: str | None = None, description: str | None = None, organism: str | None = None) -> Column:
    """All given words must be in their field; case doesn't count."""
    tests = [F.lower(F.coalesce(F.col(c), F.lit(""))).contains(v.lower()) for c, v in (("title", title), ("summary", description), ("organism", organism)) if v]
    if not tests:
        raise ValueError("give a title, a description or an organism")
    return reduce(and_, tests)


def catalog_query(title: str | None = None, description: str | None = None, organism: str | None = None, entry_type: str = "GSE") -> str:
    """The same condition as a text query of a public catalog."""
    parts = [f'"{v}"[{f}]' for v, f in ((title, "Title"), (description, "Description"), (organism, "Organism")) if v]
    if not parts:
        raise ValueError("give a title, a description or an organism")
    return f"({' AND '.join(parts)}) AND {entry_type}[ETYP]"


def recall_predicate(terms: list[str], organism: str | None = None) -> Column:
    """Any term in title or summary, and the organism where told."""
    text = F.lower(F.concat_ws(" ", "title", "summary"))
    hit = reduce(or_, [text.contains(t.lower()) for t in terms]) if terms else F.lit(True)
    return hit & F.lower(F.coalesce("organism", F.lit(""))).contains(organism.lower()) if organism else hit


def search_page(catalog: DataFrame, predicate: Column, retmax: int = 100, retstart: int = 0, order: str = "gse_id") -> DataFrame:
    """One page of hits, in order, with the number of all hits."""
    hits = catalog.where(predicate)
    total = hits.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return hits.orderBy(order).offset(retstart).limit(retmax).withColumn("total_hits", total)


def ordered_lookup(wanted: DataFrame, catalog: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """Catalog rows of the wanted keys, with their order kept as a column."""
    return wanted.select(key, order).join(catalog, key)


def platform_ids(packed: Column) -> Column:
    """['GPL96', 'GPL97'] of '96;97' or 'GPL96; GPL97'."""
    return F.transform(F.filter(F.split(F.coalesce(packed, F.lit("")), ";"), lambda x: F.trim(x) != ""), lambda x: F.regexp_replace(F.trim(x), r"^(?:GPL)?", "GPL"))


def report_rows(df: DataFrame) -> DataFrame:
    """The fixed columns of a report, absent ones '', lists joined by ';', optional ones only if the table has them, and a link."""
    kinds = dict(df.dtypes)
    text = lambda c: F.array_join(F.col(c), ";") if kinds[c].startswith("array") else F.coalesce(F.col(c).cast("string"), F.lit(""))
    cols = [(text(c) if c in kinds else F.lit("")).alias(c) for c in REPORT_COLUMNS] + [text(c).alias(c) for c in OPTIONAL_COLUMNS if c in kinds]
    return df.select(*cols, F.concat(F.lit("https://www.ncbi.nlm.nih.gov/geo/query/acc.cgi?acc="), F.coalesce("gse_id", F.lit(""))).alias("url"))


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """The head of a report for a console: titles of 50 and summaries of 60 characters."""
    return df.limit(rows).withColumn("title", F.substring("title", 1, 50)).withColumn("summary", F.substring("summary", 1, 60))


def content_summary(platforms: DataFrame, content: str = "array_content", key: str = "gse_id") -> DataFrame:
    """(key, array_content): sorted distinct contents joined by ';'."""
    return platforms.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(content)), ";").alias("array_content"))


def ranked_first(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an order: one aggregate over a struct, no window."""
    rest = [c for c in df.columns if c not in key]
    ranks = [o.alias(f"__o{i}") for i, o in enumerate(order)]
    return df.groupBy(*key).agg(F.min(F.struct(*ranks, *rest)).alias("s")).select(*key, *[F.col(f"s.`{c}`").alias(c) for c in rest])


def readiness(cohorts: DataFrame, facts: DataFrame, parents: DataFrame, requested: DataFrame) -> DataFrame:
    """One row a cohort: whether its data are ready, and why not.

    ``cohorts`` (gse_id, parent_series), ``facts`` (gse_id, title, organism, assay_type,
    n_samples, expression_status, expression_file, has_annotation), ``parents`` (gse_id,
    orphan_note), ``requested`` (gse_id).
    """
    asked = requested.select("gse_id").distinct().withColumn("in_requested_list", F.lit(True))
    rows = cohorts.join(facts.withColumn("downloaded", F.lit(True)), "gse_id", "left").join(parents.select("gse_id", "orphan_note").withColumn("is_parent", F.lit(True)), "gse_id", "left").join(asked, "gse_id", "left")
    got, parent = F.coalesce("downloaded", F.lit(False)), F.coalesce("is_parent", F.lit(False)) & ~F.coalesce("has_annotation", F.lit(False))
    ready = got & ~parent & (F.col("expression_status") == "ok")
    reason = (
        F.when(~got, "not downloaded yet")
        .when(parent, "a parent record without data of its own; its subseries have them")
        .when(F.coalesce(ready, F.lit(False)), "")
        .otherwise(F.coalesce(F.nullif("expression_status", F.lit("")), F.lit("no expression_status recorded")))
    )
    note = F.nullif(F.coalesce("orphan_note", F.lit("")), F.lit(""))
    return rows.select(
        "gse_id",
        F.coalesce("parent_series", F.lit("")).alias("parent_series"),
        F.coalesce("in_requested_list", F.lit(False)).alias("in_requested_list"),
        got.alias("downloaded"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("title", "organism", "assay_type", "expression_status")],
        "n_samples",
        F.when(F.coalesce(ready, F.lit(False)), "ready").otherwise("not_ready").alias("readiness"),
        F.when(F.coalesce(ready, F.lit(False)), F.coalesce("expression_file", F.lit(""))).otherwise("").alias("expression_file"),
        F.concat_ws("; ", F.nullif(reason, F.lit("")), F.when(got, note)).alias("reason_if_not_ready"),
    )


def equal_width_histogram(df: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """(bin, low, high, n): right-closed bins of equal width, the first one closed at both ends; empty bins have no row."""
    bounds = df.agg(F.min(value).alias("a"), F.max(value).alias("b"))
    low, high = bounds.select("a").scalar(), bounds.select("b").scalar()
    width = F.nullif((high - low) / bins, F.lit(0.0))
    slot = F.when(width.isNull(), 1).otherwise(F.greatest(F.lit(1), F.least(F.ceil((F.col(value) - low) / width), F.lit(bins)))).cast("int")
    counted = df.where(F.col(value).isNotNull()).groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("bin", (low + (F.col("bin") - 1) * F.coalesce(width, F.lit(0.0))).alias("low"), (low + F.col("bin") * F.coalesce(width, F.lit(0.0))).alias("high"), "n")


def top_k(df: DataFrame, group: list[str], value: str, k: int) -> DataFrame:
    """The k most frequent values of each group, ties in order of the value."""
    counted = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("n"), value))).where(F.col("rank") <= k)
