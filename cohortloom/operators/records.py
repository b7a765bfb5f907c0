"""Records of series and samples as tables: one row a series, one row a sample, and notes on both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions import classify as C
from cohortloom.functions.clinical import characteristics, species_class
from cohortloom.operators import matrix as M

# Fixed value: shape of names of columns that tell a time to an event.
SURVIVAL_NAME = r"(?i)\b(os|pfs|dfs|rfs|efs|dss|css)\b|surviv|follow.?up|time.to.(death|event|progression|relapse|recurrence)"


def first_or_empty(values: Column) -> Column:
    """The first of a list, '' for an empty or null one."""
    return F.coalesce(F.try_element_at(values, F.lit(1)), F.lit(""))


def _of(key: str, all_of: str | None = None) -> Column:
    """Of rows (key, ord, value) of a group: the first value of a key, or all of them joined in order; '' without any."""
    wanted = F.when(F.col("key") == key, F.struct("ord", "value"))
    if all_of is None:
        return F.coalesce(F.min(wanted)["value"], F.lit(""))
    return F.array_join(F.transform(F.array_sort(F.collect_list(wanted)), lambda x: x["value"]), all_of)


def series_rows(metadata: DataFrame) -> DataFrame:
    """One row a series of ``sources.soft.read_metadata``: title, summary, design, organism, platforms with their classes, samples, dates.

    organism is that of the first sample that tells one; platforms are joined by ';' in order.
    """
    own = metadata.where("entity = 'SERIES'").groupBy("gse_id").agg(
        *[_of(k).alias(n) for k, n in (("title", "title"), ("overall_design", "overall_design"), ("submission_date", "submission_date"))], _of("summary", " ").alias("summary"), _of("pubmed_id", ";").alias("pubmed_ids")
    )
    platform = metadata.where("entity = 'PLATFORM'").groupBy("gse_id", F.col("entity_id").alias("platform_id")).agg(*[_of(k).alias(k) for k in ("technology", "title", "manufacturer", "data_row_count")])
    details = platform.withColumn("c", C.platform_class(F.col("technology"), F.col("title"), F.col("manufacturer"), F.col("data_row_count"))).groupBy("gse_id").agg(F.array_sort(F.collect_list(F.struct("platform_id", "c.*"))).alias("d"))
    details = details.select("gse_id", F.array_join(F.transform("d", lambda x: x["platform_id"]), ";").alias("platforms"), F.to_json("d").alias("platform_details"))
    samples = metadata.where("entity = 'SAMPLE'").groupBy("gse_id").agg(F.count_distinct("entity_id").alias("n_samples"))
    out = own.join(details, "gse_id", "left").join(samples, "gse_id", "left").join(series_organism(metadata), "gse_id", "left")
    return out.select(
        "gse_id", "title", "summary", "overall_design", F.coalesce("organism", F.lit("")).alias("organism"), F.coalesce("platforms", F.lit("")).alias("platforms"), F.coalesce("platform_details", F.lit("[]")).alias("platform_details"),
        F.coalesce("n_samples", F.lit(0)).alias("n_samples"), "submission_date", "pubmed_ids",
    )


def series_organism(metadata: DataFrame) -> DataFrame:
    """(gse_id, organism) of the first sample, in order of the ids, that tells one."""
    told = metadata.where("entity = 'SAMPLE' and key = 'organism_ch1' and trim(value) <> ''")
    return told.groupBy("gse_id").agg(F.min_by("value", F.struct("entity_id", "ord")).alias("organism"))


def human_gate(organism: Column) -> Column:
    """Whether a series may pass as human; one without an organism passes."""
    return species_class(organism).isin("human", "unknown")


def series_reference_channel(metadata: DataFrame) -> DataFrame:
    """(gse_id, reference_channel): the channel that nine in ten of the samples' clear hints call the reference, else null."""
    text = lambda n: F.concat_ws(" ", F.array_sort(F.collect_list(F.when(F.col("key").isin(f"source_name_ch{n}", f"characteristics_ch{n}"), F.col("value")))))
    hints = metadata.where("entity = 'SAMPLE'").groupBy("gse_id", "entity_id").agg(C.reference_hint(text(1), text(2)).alias("hint"))
    ones = hints.groupBy("gse_id").agg(F.avg((F.col("hint") == 1).cast("double")).alias("ones"))
    return ones.select("gse_id", F.when(F.col("ones") >= M.HINT_SHARE, 1).when(1 - F.col("ones") >= M.HINT_SHARE, 2).alias("reference_channel"))


def sample_rows(metadata: DataFrame) -> DataFrame:
    """One row a sample: its fixed fields, its characteristics as a map, and of two-channel samples the second channel's.

    Keys of the second channel end in ``_ch2``; reference_channel is the series' call and is told
    only for two-channel samples.
    """
    fixed = ["title", "source_name_ch1", "organism_ch1", "molecule_ch1", "platform_id", "library_selection", "library_strategy", "data_row_count", "channel_count", "source_name_ch2", "organism_ch2", "molecule_ch2"]
    lines = lambda n: F.transform(F.array_sort(F.collect_list(F.when(F.col("key") == f"characteristics_ch{n}", F.struct("ord", "value")))), lambda x: x["value"])
    protocol = F.concat_ws(" ", F.array_sort(F.collect_list(F.when(F.col("key").rlike("protocol"), F.col("value")))))
    rows = metadata.where("entity = 'SAMPLE'").groupBy("gse_id", F.col("entity_id").alias("gsm_id")).agg(*[_of(k).alias(k) for k in fixed], _of("description", " ").alias("description"), lines(1).alias("l1"), lines(2).alias("l2"), protocol.alias("protocol"))
    two = F.trim("channel_count") == "2"
    second = F.transform_keys(characteristics(F.col("l2")), lambda k, _: F.concat(k, F.lit("_ch2")))
    out = rows.join(series_reference_channel(metadata), "gse_id", "left")
    only_two = [F.when(two, F.col(c)).alias(c) for c in ("channel_count", "source_name_ch2", "organism_ch2", "molecule_ch2", "reference_channel")]
    return out.select(
        "gsm_id", "gse_id", *fixed[:5], "description", *fixed[5:8], C.rnaseq_library(F.col("library_selection"), F.col("protocol")).alias("rnaseq_library_type"),
        F.when(two, F.map_concat(characteristics(F.col("l1")), second)).otherwise(characteristics(F.col("l1"))).alias("characteristics"), *only_two,
    )


def orphan_note(samples: Column, files: Column) -> Column:
    """A sentence on what a parent record holds beyond its subseries; '' where nothing is left (arrays of ids and of file names)."""
    part = lambda items, what: F.when(F.size(F.coalesce(items, F.array().cast("array<string>"))) > 0, F.concat(F.size(items).cast("string"), F.lit(f" {what} of the parent record in no subseries: "), F.array_join(items, ", ")))
    text = F.concat_ws("; ", part(samples, "sample(s)"), part(files, "supplementary file(s)"))
    return F.when(text == "", "").otherwise(F.concat(F.lit("the parent record has data that no subseries covers: "), text))


def requested_ids(given: list[str], report: DataFrame, key: str = "gse_id") -> DataFrame:
    """(gse_id, ord): the given ids and then those of a report, each once, in order; nulls and blanks are left out."""
    first = report.sparkSession.createDataFrame([(g, i) for i, g in enumerate(given)], "gse_id string, ord long")
    own = report.select(F.trim(key).alias("gse_id"), (F.lit(len(given)) + F.monotonically_increasing_id()).alias("ord"))
    return first.unionByName(own).where("gse_id is not null and gse_id <> ''").groupBy("gse_id").agg(F.min("ord").alias("ord"))


def listed_dropped(dropped: DataFrame, listed: DataFrame, key: str = "symbol") -> DataFrame:
    """Dropped genes that stand in a list of genes of interest."""
    return dropped.join(listed.select(key).distinct(), key, "left_semi")


def numeric_summaries(df: DataFrame, columns: list[str], examples: int = 5) -> DataFrame:
    """(column_name, low, high, examples): the range of the numbers of each column, and its least distinct texts.

    low and high are null where no value is a number.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])).alias("c")).select("c.*").where("value is not null")
    distinct = long.distinct()
    ranges = distinct.groupBy("column_name").agg(F.min(F.col("value").try_cast("double")).alias("low"), F.max(F.col("value").try_cast("double")).alias("high"))
    # The engine keeps the first of each partition before they are shuffled.
    place = F.row_number().over(Window.partitionBy("column_name").orderBy("value"))
    least = distinct.withColumn("p", place).where(F.col("p") <= examples).groupBy("column_name").agg(F.array_join(F.array_sort(F.collect_list("value")), "; ").alias("examples"))
    return ranges.join(least, "column_name").select("column_name", "low", "high", "examples")


def survival_like(profile: DataFrame) -> DataFrame:
    """Rows of ``harmonize.column_profile`` whose column is numeric, of many values, and named as a time to an event."""
    return profile.where(F.col("is_numeric") & F.col("is_high_cardinality") & F.col("column_name").rlike(SURVIVAL_NAME))


def channel_matrices(cells: DataFrame, probe_map: DataFrame, calls: DataFrame) -> DataFrame:
    """(cohort_id, role, feature_id, sample_id, value): gene matrices of both channels (role ch1, ch2) and, where a call is sure, the signal and reference again under their names.

    ``cells`` have a channel; ``calls`` (cohort_id, signal_channel) as from ``matrix.reference_channel``.
    """
    named = cells.withColumn("cohort_id", F.concat_ws("\x1f", "cohort_id", F.col("channel").cast("string")))
    genes = M.probes_to_genes(named, probe_map)
    parts = F.split("cohort_id", "\x1f")
    genes = genes.select(parts[0].alias("cohort_id"), parts[1].cast("int").alias("channel"), F.col("gene_key").alias("feature_id"), "sample_id", "value")
    known = genes.join(calls.select("cohort_id", "signal_channel"), "cohort_id", "left")
    roles = F.array_compact(F.array(F.concat(F.lit("ch"), F.col("channel").cast("string")), F.when(F.col("signal_channel").isNotNull(), F.when(F.col("signal_channel") == F.col("channel"), "signal").otherwise("reference"))))
    return known.select("cohort_id", F.explode(roles).alias("role"), "feature_id", "sample_id", "value")
