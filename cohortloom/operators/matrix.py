"""Algebra of long matrices: (cohort_id, feature_id, sample_id, value), one row per cell.

Every whole-matrix decision of a cohort (is it in log scale, is it transposed) is one
aggregate over its cells joined back, so a job covers all cohorts at once.  That aggregate has
a row a cohort: it is counted and broadcast, so the cells aren't shuffled for it; it reads
them once more, so cells that are dear to compute should be written before
(``session.cut_lineage``).  Missing cells are null; NaN is turned to null on the way in.
"""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.session import bounded, ship

#: Any value above it tells a matrix isn't in log scale.
LOG2_LIMIT = 50.0
#: Orientation is judged from so many rows on.
ORIENTATION_ROWS = 10
AGGREGATES = {"mean": F.avg, "sum": F.sum, "median": F.median, "max": F.max, "min": F.min}


def clean_cells(cells: DataFrame) -> DataFrame:
    """NaN as null, values as double."""
    return cells.withColumn("value", F.nanvl(F.col("value").cast("double"), F.lit(None).cast("double")))


def map_probes(cells: DataFrame, probe_map: DataFrame) -> DataFrame:
    """Cells with the gene of their probe: inner join on the probe id; repeated probes in the map fan out.

    The key is the entrez id where there is one, else the symbol; probes with neither are dropped.
    """
    keyed = probe_map.select(F.col("probe_id").cast("string").alias("feature_id"), "gene_symbol", "entrez_id", F.coalesce("entrez_id", "gene_symbol").alias("gene_key")).where("gene_key is not null")
    return clean_cells(cells).withColumn("feature_id", F.col("feature_id").cast("string")).join(keyed, "feature_id")


def probes_to_genes(cells: DataFrame, probe_map: DataFrame, agg: str = "mean") -> DataFrame:
    """(cohort_id, gene_key, gene_symbol, entrez_id, sample_id, value): probes aggregated to genes; nulls are skipped."""
    return (
        map_probes(cells, probe_map)
        .groupBy("cohort_id", "gene_key", "sample_id")
        .agg(AGGREGATES[agg]("value").alias("value"), F.min("gene_symbol").alias("gene_symbol"), F.min("entrez_id").alias("entrez_id"))
    )


def symbol_sums(cells: DataFrame, symbols: DataFrame) -> DataFrame:
    """Features replaced by their symbol (feature_id, symbol) and summed; unmapped ones are dropped, an all-null sum is 0."""
    mapped = clean_cells(cells).join(symbols.select("feature_id", "symbol").where("symbol is not null"), "feature_id")
    return mapped.groupBy("cohort_id", F.col("symbol").alias("feature_id"), "sample_id").agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("value"))


def _sample_sum() -> Column:
    """The sum of a cell's sample: one shuffle by sample and no join; a sample's cells are as many as its features."""
    return F.coalesce(F.sum("value").over(Window.partitionBy("cohort_id", "sample_id")), F.lit(0.0))


def _sample_totals(cells: DataFrame) -> DataFrame:
    return cells.groupBy("cohort_id", "sample_id").agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"))


def tpm(cells: DataFrame, lengths: DataFrame) -> DataFrame:
    """Transcripts per million by gene length (feature_id, length); genes without length are left out, empty samples are null."""
    rate = clean_cells(cells).join(lengths.select("feature_id", "length").where("length > 0"), "feature_id").withColumn("value", F.col("value") / (F.col("length") / 1000.0))
    total = F.nullif(_sample_sum() / 1e6, F.lit(0.0))
    return rate.select("cohort_id", "feature_id", "sample_id", (F.col("value") / total).alias("value"))


def per_million(cells: DataFrame) -> DataFrame:
    """Values scaled so that each sample sums to a million; samples whose sum isn't positive become null."""
    total = _sample_sum()
    return clean_cells(cells).withColumn("total", total).select("cohort_id", "feature_id", "sample_id", (F.col("value") / F.when(F.col("total") > 0, F.col("total")) * 1e6).alias("value"))


def empty_samples(cells: DataFrame) -> DataFrame:
    """Samples whose sum isn't positive: they can't be scaled."""
    return _sample_totals(clean_cells(cells)).where("total <= 0")


def scale_facts(cells: DataFrame, limit: float = LOG2_LIMIT) -> DataFrame:
    """(cohort_id, max_value, n_negative, n_features, n_samples, needs_log2, transposed, integer_like) in one aggregate."""
    v = F.col("value")
    whole = F.bool_and(F.abs(v - F.round(v)) <= 1e-6 + 1e-5 * F.abs(F.round(v)))
    n_features, n_samples = F.count_distinct("feature_id"), F.count_distinct("sample_id")
    return clean_cells(cells).groupBy("cohort_id").agg(
        F.max(v).alias("max_value"),
        F.count_if(v < 0).alias("n_negative"),
        n_features.alias("n_features"),
        n_samples.alias("n_samples"),
        F.coalesce(F.max(v) > limit, F.lit(False)).alias("needs_log2"),
        ((n_features >= ORIENTATION_ROWS) & (n_samples > n_features)).alias("transposed"),
        F.coalesce(whole, F.lit(False)).alias("integer_like"),
    )


def _scale(cells: DataFrame, limit: float) -> DataFrame:
    """Cells with the flags of their cohort; the aggregate has one row a cohort."""
    cells = clean_cells(cells)
    v = F.col("value")
    facts = cells.groupBy("cohort_id").agg(F.coalesce(F.max(v) > limit, F.lit(False)).alias("needs_log2"), (F.count_if(v < 0) > 0).alias("has_negative"))
    return cells.join(bounded(facts), "cohort_id")


def log2_where_linear(cells: DataFrame, limit: float = LOG2_LIMIT, keep_negative: bool = False) -> DataFrame:
    """log2(x + 1) for cohorts with a value above the limit; with ``keep_negative`` not for those with negative values."""
    flag = F.col("needs_log2") & ~F.col("has_negative") if keep_negative else F.col("needs_log2")
    return _scale(cells, limit).select("cohort_id", "feature_id", "sample_id", F.when(flag, F.log2(F.col("value") + 1)).otherwise(F.col("value")).alias("value"))


def linear_scale(cells: DataFrame, limit: float = LOG2_LIMIT) -> DataFrame:
    """The inverse: 2^x - 1 for cohorts in log scale; nothing below 0. was_log2 tells which; negative values are counted first."""
    linear = F.when(F.col("needs_log2"), F.col("value")).otherwise(F.pow(F.lit(2.0), F.col("value")) - 1)
    return _scale(cells, limit).select("cohort_id", "feature_id", "sample_id", F.when(F.col("value").isNotNull(), F.greatest(linear, F.lit(0.0))).alias("value"), (~F.col("needs_log2")).alias("was_log2"))


def matrix_qc(cells: DataFrame) -> DataFrame:
    """(cohort_id, notes): what stands out in each final matrix; '' where nothing does."""
    f = scale_facts(cells)
    notes = F.concat_ws(
        "; ",
        F.when(F.col("needs_log2"), F.concat(F.lit("linear-scale (max "), F.format_string("%.1f", "max_value"), F.lit(")"))),
        F.when(F.col("n_negative") > 0, F.concat(F.col("n_negative").cast("string"), F.lit(" negative values"))),
        F.when(F.col("transposed"), F.concat(F.lit("more samples ("), F.col("n_samples").cast("string"), F.lit(") than features ("), F.col("n_features").cast("string"), F.lit(")"))),
    )
    return f.select("cohort_id", notes.alias("notes"))


def low_feature_count(cells: DataFrame, least: int) -> DataFrame:
    """(cohort_id, n_features) of cohorts with some but fewer than ``least`` features."""
    return cells.groupBy("cohort_id").agg(F.count_distinct("feature_id").alias("n_features")).where((F.col("n_features") > 0) & (F.col("n_features") < least))


def normalized(cells: DataFrame, limit: float = LOG2_LIMIT) -> DataFrame:
    """A final matrix: turned back where samples outnumber features, then in log scale unless it has negative values."""
    facts = bounded(scale_facts(cells, limit).select("cohort_id", "transposed", (F.col("needs_log2") & (F.col("n_negative") == 0)).alias("to_log2")))
    feature, sample = F.col("feature_id").cast("string"), F.col("sample_id").cast("string")
    return clean_cells(cells).join(facts, "cohort_id").select(
        "cohort_id",
        F.when(F.col("transposed"), sample).otherwise(feature).alias("feature_id"),
        F.when(F.col("transposed"), feature).otherwise(sample).alias("sample_id"),
        F.when(F.col("to_log2"), F.log2(F.col("value") + 1)).otherwise(F.col("value")).alias("value"),
    )


def restricted(cells: DataFrame, clean: DataFrame) -> DataFrame:
    """Cells of the features in ``clean`` (feature_id), summed where a feature repeats."""
    return clean_cells(cells).join(clean.select("feature_id").distinct(), "feature_id", "left_semi").groupBy("cohort_id", "feature_id", "sample_id").agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("value"))


def combined_first(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Values of both by key, the first's where it has one: a union and one aggregate instead of an outer join."""
    a = first.select(*keys, F.col("value").alias("a"), F.lit(None).cast("double").alias("b"))
    b = second.select(*keys, F.lit(None).cast("double").alias("a"), F.col("value").alias("b"))
    return a.unionByName(b).groupBy(*keys).agg(F.coalesce(F.max("a"), F.max("b")).alias("value"))


def first_map_wins(maps: list[DataFrame]) -> DataFrame:
    """Probe maps united; of several rows of a probe the one of the earliest map counts."""
    ranked = None
    for i, m in enumerate(maps):
        part = m.withColumn("map_rank", F.lit(i))
        ranked = part if ranked is None else ranked.unionByName(part, allowMissingColumns=True)
    rest = [c for c in ranked.columns if c not in ("probe_id", "map_rank")]
    best = ranked.groupBy("probe_id").agg(F.min(F.struct("map_rank", *rest)).alias("s"))
    return best.select("probe_id", *[F.col(f"s.{c}").alias(c) for c in rest])


def gene_frames_joined(left: DataFrame, right: DataFrame, keys: list[str], left_value: str = "left_value", right_value: str = "right_value") -> DataFrame:
    """Full outer join of two gene frames on keys that may be null: null matches null."""
    on = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        on = c if on is None else on & c
    return left.join(right, on, "full_outer").select(*[F.coalesce(left[k], right[k]).alias(k) for k in keys], left["value"].alias(left_value), right["value"].alias(right_value))


def channel_cells(tables: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Cells of both channels from the first pair of columns a two-channel table has; none without a pair."""
    pair = next(((a, b) for a, b in pairs if a in tables.columns and b in tables.columns), None)
    if pair is None:
        return tables.select("cohort_id", "sample_id", F.lit(None).cast("string").alias("feature_id"), F.lit(0).alias("channel"), F.lit(None).cast("double").alias("value")).limit(0)
    both = F.array(*[F.struct(F.lit(i + 1).alias("channel"), F.col(f"`{c}`").cast("string").try_cast("double").alias("value")) for i, c in enumerate(pair)])
    return tables.select("cohort_id", "sample_id", F.col("ID_REF").cast("string").alias("feature_id"), F.explode(both).alias("c")).select("cohort_id", "sample_id", "feature_id", "c.*")


# Column pairs of the two channels, in the order they are tried.
CHANNEL_PAIRS = [
    ("ch1 Intensity", "ch2 Intensity"), ("CH1_SIGNAL", "CH2_SIGNAL"), ("CH1_SIGNAL_MEAN", "CH2_SIGNAL_MEAN"), ("CH1_MEAN_SIGNAL", "CH2_MEAN_SIGNAL"), ("CH1_MEAN", "CH2_MEAN"),
    ("Intensity_Cy3", "Intensity_Cy5"), ("gMedianSignal", "rMedianSignal"), ("gMeanSignal", "rMeanSignal"), ("gProcessedSignal", "rProcessedSignal"),
]
# Share of clear hints that must agree, and the least relative gap of variances.
HINT_SHARE, VARIANCE_GAP = 0.9, 0.10


def exact_medians(df: DataFrame, keys: list[str], value: str, slots: int = 1024) -> DataFrame:
    """(keys, median) of groups of any size: values are counted by slots of equal width, and only the slots that hold the middle are ordered.

    Two passes over ``df``; a slot of one group is ordered in one task, so values that crowd
    in one slot are counted by value first.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    bounds = counted.groupBy(*keys).agg(F.min("__v").alias("__low"), F.max("__v").alias("__high"), F.sum("__n").alias("__all"))
    width = F.nullif(F.col("__high") - F.col("__low"), F.lit(0.0))
    placed = counted.join(bounded(bounds), keys).withColumn("__slot", F.coalesce(F.least(F.floor((F.col("__v") - F.col("__low")) / width * slots), F.lit(slots - 1)), F.lit(0)).cast("int"))
    sums = placed.groupBy(*keys, "__slot").agg(F.sum("__n").alias("__in"), F.max("__all").alias("__all"))
    sums = sums.withColumn("__before", F.sum("__in").over(Window.partitionBy(*keys).orderBy("__slot")) - F.col("__in"))
    # The ranks of the middle, from 1; they are alike where the number of values is odd.
    first, last = F.floor((F.col("__all") + 1) / 2), F.floor(F.col("__all") / 2) + 1
    middle = bounded(sums.where((F.col("__before") < last) & (F.col("__before") + F.col("__in") >= first)).select(*keys, "__slot", "__before"))
    upto = F.col("__before") + F.sum("__n").over(Window.partitionBy(*keys, "__slot").orderBy("__v"))
    ranked = placed.join(middle, [*keys, "__slot"]).withColumn("__upto", upto)
    holds = lambda rank: F.max(F.when((F.col("__upto") >= rank) & (F.col("__upto") - F.col("__n") < rank), F.col("__v")))
    return ranked.groupBy(*keys).agg(((holds(first) + holds(last)) / 2).alias("median"))


def reference_channel(cells: DataFrame, hints: DataFrame | None = None) -> DataFrame:
    """(cohort_id, var1, var2, reference_channel, signal_channel, method) for cells with a ``channel``.

    The reference varies less over samples: median over features of the variance of
    log2(max(x, 1)), a gap of 10 % at least.  ``hints`` (cohort_id, hint) are the clear
    hints of samples' texts; nine in ten must agree.  Two calls that differ are ambiguous.
    """
    variance = clean_cells(cells).groupBy("cohort_id", "channel", "feature_id").agg(F.var_samp(F.log2(F.greatest(F.col("value"), F.lit(1.0)))).alias("v"))
    medians = exact_medians(variance.where("v is not null"), ["cohort_id", "channel"], "v")
    of = lambda n: F.max(F.when(F.col("channel") == n, F.col("median")))
    by = variance.select("cohort_id").distinct().join(medians, "cohort_id", "left").groupBy("cohort_id").agg(of(1).alias("var1"), of(2).alias("var2"))
    low, high = F.least("var1", "var2"), F.greatest("var1", "var2")
    called = by.withColumn("by_variance", F.when(F.col("var1").isNotNull() & F.col("var2").isNotNull() & (high > 0) & ((high - low) / high >= VARIANCE_GAP), F.when(F.col("var1") <= F.col("var2"), 1).otherwise(2)))
    if hints is None:
        called = called.withColumn("by_hint", F.lit(None).cast("int"))
    else:
        said = hints.where("hint is not null").groupBy("cohort_id").agg(F.avg((F.col("hint") == 1).cast("double")).alias("ones"))
        said = said.select("cohort_id", F.when(F.col("ones") >= HINT_SHARE, 1).when(1 - F.col("ones") >= HINT_SHARE, 2).alias("by_hint"))
        called = called.join(said, "cohort_id", "left")
    chosen = F.when(F.col("by_hint").isNotNull() & F.col("by_variance").isNotNull() & (F.col("by_hint") != F.col("by_variance")), F.lit(None)).otherwise(F.coalesce("by_hint", "by_variance"))
    method = F.when(chosen.isNull(), "ambiguous").when(F.col("by_hint").isNotNull() & F.col("by_variance").isNotNull(), "metadata+variance").when(F.col("by_hint").isNotNull(), "metadata").otherwise("variance")
    return called.select("cohort_id", "var1", "var2", chosen.alias("reference_channel"), (3 - chosen).alias("signal_channel"), method.alias("method"))


def quantile_normalized(cells: DataFrame) -> DataFrame:
    """Every sample given the mean distribution of its cohort's samples: value by rank, ties in order of the feature."""
    order = Window.partitionBy("cohort_id", "sample_id").orderBy("value", "feature_id")
    ranked = clean_cells(cells).where("value is not null").withColumn("rank", F.row_number().over(order))
    means = ranked.groupBy("cohort_id", "rank").agg(F.avg("value").alias("mean"))
    return ranked.join(means, ["cohort_id", "rank"]).select("cohort_id", "feature_id", "sample_id", F.col("mean").alias("value"))


def median_polished(cells: DataFrame, probe_sets: DataFrame, rounds: int = 10) -> DataFrame:
    """(cohort_id, feature_id, sample_id, value): probes (feature_id) of a set (set_id) summarized by median polish.

    A set is a handful of probes by the samples of one cohort: one group of one task.
    """

    def polish(table: pd.DataFrame) -> pd.DataFrame:
        m = table.pivot_table(index="feature_id", columns="sample_id", values="value", aggfunc="mean").to_numpy(copy=True)
        samples = sorted(table["sample_id"].unique())
        total, row, col = 0.0, np.zeros(m.shape[0]), np.zeros(m.shape[1])
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")  # samples without any value
            for _ in range(rounds):
                d = np.nanmedian(m, axis=1)
                m, row = m - d[:, None], row + d
                shift = np.nanmedian(col)
                col, total = col - shift, total + shift
                d = np.nanmedian(m, axis=0)
                m, col = m - d[None, :], col + d
                shift = np.nanmedian(row)
                row, total = row - shift, total + shift
        return pd.DataFrame({"cohort_id": table["cohort_id"].iat[0], "feature_id": table["set_id"].iat[0], "sample_id": samples, "value": total + col})

    ship(cells.sparkSession)
    joined = clean_cells(cells).where("value is not null").join(probe_sets.select("feature_id", "set_id"), "feature_id")
    return joined.groupBy("cohort_id", "set_id").applyInPandas(polish, "cohort_id string, feature_id string, sample_id string, value double")


def wide(cells: DataFrame, samples: list[str] | None = None) -> DataFrame:
    """A matrix with a column per sample, for a sink; only for one cohort of a known list of samples."""
    return cells.groupBy("feature_id").pivot("sample_id", samples).agg(F.first("value"))


def rounded(cells: DataFrame, places: int = 3) -> DataFrame:
    """Values as a matrix file holds them."""
    return cells.withColumn("value", F.round("value", places))


def guess_unit(integer_like: Column, id_type: Column) -> Column:
    """count for whole numbers, cpm for transcripts, else fpkm."""
    return F.when(integer_like, "count").when(id_type == "transcript", "cpm").otherwise("fpkm")
