"""Samples matched with samples, and expression columns with samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.clinical import match_key
from cohortloom.session import cut_lineage, ranked_in

# Confidence of a match by how it was made.
CONFIDENCE = {"exact_gsm_id": 1.0, "exact": 0.95, "normalized_exact": 0.9, "substring": 0.75, "reverse_substring": 0.6, "positional_fallback": 0.5}
_LEVELS = list(CONFIDENCE)[:5]
# Companion chips, the words of each in a title, and its ending.
COMPANIONS = [("GPL96", "GPL97")]
CHIP_WORDS = {"GPL96": ["hg-u133a", "hgu133a", "u133a"], "GPL97": ["hg-u133b", "hgu133b", "u133b"]}
CHIP_ENDINGS = {"GPL96": r"[\s_-]a$", "GPL97": r"[\s_-]b$"}


def companion_title(title: Column, platform: str) -> Column:
    """A title without the words that tell the chips of a pair apart."""
    text = F.lower(title)
    for word in CHIP_WORDS.get(platform, []):
        text = F.replace(text, F.lit(word), F.lit(" "))
    text = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.trim(F.regexp_replace(text, CHIP_ENDINGS[platform], "")) if platform in CHIP_ENDINGS else text


def paired_samples(left: DataFrame, right: DataFrame) -> DataFrame:
    """(cohort_id, pair_key, left_id, right_id) for samples (cohort_id, sample_id, pair_key) of two platforms.

    A cohort's pairs hold only if they are one to one and complete: as many samples
    on either side, no empty and no repeated key, none left over.
    """
    sides = left.select("cohort_id", "pair_key", F.col("sample_id").alias("left_id"), F.lit(None).cast("string").alias("right_id")).unionByName(
        right.select("cohort_id", "pair_key", F.lit(None).cast("string").alias("left_id"), F.col("sample_id").alias("right_id"))
    )
    keys = sides.groupBy("cohort_id", "pair_key").agg(F.count("left_id").alias("nl"), F.count("right_id").alias("nr"), F.max("left_id").alias("left_id"), F.max("right_id").alias("right_id"))
    fits = (F.col("nl") == 1) & (F.col("nr") == 1) & (F.coalesce("pair_key", F.lit("")) != "")
    good = keys.groupBy("cohort_id").agg(F.bool_and(fits).alias("good")).where("good").select("cohort_id")
    return keys.join(good, "cohort_id").select("cohort_id", "pair_key", "left_id", "right_id")


def collapsed_pairs(samples: DataFrame, pairs: DataFrame) -> DataFrame:
    """Sample rows with each pair as one row: ids and platforms joined by '+', the right one's row gone."""
    platform = samples.select(F.col("sample_id").alias("right_id"), F.col("platform_id").alias("right_platform"))
    joined = pairs.select("left_id", "right_id").join(platform, "right_id", "left")
    kept = samples.join(pairs.select(F.col("right_id").alias("sample_id")), "sample_id", "left_anti")
    out = kept.join(joined, kept["sample_id"] == joined["left_id"], "left")
    paired = F.col("right_id").isNotNull()
    return out.select(
        F.when(paired, F.concat_ws("+", "sample_id", "right_id")).otherwise(F.col("sample_id")).alias("sample_id"),
        F.when(paired, F.concat_ws("+", "platform_id", "right_platform")).otherwise(F.col("platform_id")).alias("platform_id"),
        *[c for c in samples.columns if c not in ("sample_id", "platform_id")],
    )


#: Length of the pieces of text by which containing is looked for; shorter texts are looked for whole.
GRAM = 5


def _grams(text: Column, size: int) -> Column:
    """All distinct substrings of a text that have one length."""
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substr(text, i, F.lit(size)))))


def contained(parts: DataFrame, wholes: DataFrame) -> DataFrame:
    """(cohort_id, part, whole): the distinct texts of ``parts`` (cohort_id, part) inside those of ``wholes`` (cohort_id, whole) of their cohort.

    A part is looked for by the one of its pieces of ``GRAM`` signs that the fewest wholes of its
    cohort have, then verified; so a word that all texts share joins nothing.  Parts shorter
    than that are themselves such a piece.
    """
    long_parts = parts.where(F.length("part") >= GRAM)
    of_wholes = wholes.select("cohort_id", "whole", F.explode(_grams(F.col("whole"), GRAM)).alias("gram"))
    of_parts = long_parts.select("cohort_id", "part", F.explode(_grams(F.col("part"), GRAM)).alias("gram"))
    counts = of_wholes.groupBy("cohort_id", "gram").agg(F.count(F.lit(1)).alias("n"))
    # A piece that no whole has tells that the part is in none.
    rare = of_parts.join(counts, ["cohort_id", "gram"], "left").groupBy("cohort_id", "part").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("g")).where("g.n > 0")
    long_pairs = rare.select("cohort_id", "part", F.col("g.gram").alias("gram")).join(of_wholes, ["cohort_id", "gram"]).where(F.col("whole").contains(F.col("part"))).select("cohort_id", "part", "whole")
    sizes = sorted(r["n"] for r in parts.where((F.length("part") < GRAM) & (F.length("part") > 0)).select(F.length("part").alias("n")).distinct().collect())  # at most GRAM - 1 rows
    if not sizes:
        return long_pairs
    short = wholes.select("cohort_id", "whole", F.explode(F.flatten(F.array_compact(F.array(*[_grams(F.col("whole"), n) for n in sizes])))).alias("part"))
    return long_pairs.unionByName(short.join(parts.where(F.length("part") < GRAM), ["cohort_id", "part"]).select("cohort_id", "part", "whole"))


def matched_columns(columns: DataFrame, samples: DataFrame, text_columns: list[str]) -> DataFrame:
    """(cohort_id, expression_id, gsm_id, match_method, confidence): the sample each expression column means.

    Levels: the sample id, a text as it is, a text without signs, a text that holds
    the column's name, a name that holds the text; within a level the texts in
    order.  A level and text count only if they tell exactly one sample.

    Texts are counted by value before any join, so a label that thousands of samples share is
    one row; these counts and the names still open after the equal levels are written.
    """
    cols = columns.select("cohort_id", "expression_id", match_key(F.col("expression_id")).alias("norm"))
    texts = samples.select(
        "cohort_id", "gsm_id", F.posexplode(F.array(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("nan")) for c in text_columns])).alias("place", "text")
    )
    one = [F.count(F.lit(1)).alias("n"), F.max("gsm_id").alias("gsm_id")]
    many = [F.sum("n").alias("n"), F.max("gsm_id").alias("gsm_id")]
    hit = lambda df, level: df.select("cohort_id", "expression_id", F.struct(F.lit(level).alias("level"), "place", "gsm_id").alias("hit"))

    ids = samples.groupBy("cohort_id", F.col("gsm_id").alias("expression_id")).agg(*one).where("n = 1").withColumn("place", F.lit(-1))
    by_text = cut_lineage(texts.groupBy("cohort_id", "place", "text").agg(*one).withColumn("text_norm", match_key(F.col("text"))))
    exact = by_text.where("n = 1").withColumnRenamed("text", "expression_id")
    by_norm = by_text.groupBy("cohort_id", "place", F.col("text_norm").alias("norm")).agg(*many)
    named = cols.where("norm <> ''")
    equal = hit(cols.join(ids, ["cohort_id", "expression_id"]), 0).unionByName(hit(cols.join(exact, ["cohort_id", "expression_id"]), 1)).unionByName(hit(named.join(by_norm.where("n = 1"), ["cohort_id", "norm"]), 2))
    equal = cut_lineage(equal)
    left = cut_lineage(named.join(equal.select("cohort_id", "expression_id").distinct(), ["cohort_id", "expression_id"], "left_anti"))
    names = left.select("cohort_id", "norm").distinct()
    labels = by_text.where("text_norm <> ''").select("cohort_id", F.col("text_norm").alias("label")).distinct().join(left.select("cohort_id").distinct(), "cohort_id", "left_semi")
    of_label = by_norm.withColumnRenamed("norm", "label")

    def told_by(part: str, whole: str, parts: DataFrame, wholes: DataFrame) -> DataFrame:
        """Names that stand in such a relation to the texts of exactly one sample."""
        pairs = contained(parts.toDF("cohort_id", "part"), wholes.toDF("cohort_id", "whole")).toDF("cohort_id", part, whole)
        return left.join(pairs.join(of_label, ["cohort_id", "label"]).groupBy("cohort_id", "norm", "place").agg(*many).where("n = 1"), ["cohort_id", "norm"])

    hits = equal.unionByName(hit(told_by("norm", "label", names, labels), 3)).unionByName(hit(told_by("label", "norm", labels, names), 4))
    best = hits.groupBy("cohort_id", "expression_id").agg(F.min("hit").alias("hit"))
    told = F.col("hit").isNotNull()
    method = F.when(told, F.element_at(F.array(*[F.lit(m) for m in _LEVELS]), F.col("hit.level") + 1))
    score = F.when(told, F.element_at(F.array(*[F.lit(CONFIDENCE[m]) for m in _LEVELS]), F.col("hit.level") + 1))
    return columns.join(best, ["cohort_id", "expression_id"], "left").select(
        *[c for c in columns.columns], F.col("hit.gsm_id").alias("gsm_id"), F.coalesce(method, F.lit("unmatched")).alias("match_method"), F.coalesce(score, F.lit(0.0)).alias("confidence")
    )


def positional_matches(matches: DataFrame, samples: DataFrame, column_order: str = "ord", sample_order: str = "ord") -> DataFrame:
    """Matches whose open columns are given the unused samples in order, where a cohort has as many of either.

    ``matches`` are read several times and should be written.  Rows of equal order are
    ranked by their id; no task ranks a whole cohort.
    """
    used = matches.where("gsm_id is not null").select("cohort_id", "gsm_id").distinct()
    free = samples.join(used, ["cohort_id", "gsm_id"], "left_anti").select("cohort_id", F.col("gsm_id").alias("given"), F.col(sample_order).alias("o"))
    open_cols = matches.where("gsm_id is null").select("cohort_id", "expression_id", F.col(column_order).alias("o"))
    n_free, n_open = free.groupBy("cohort_id").agg(F.count(F.lit(1)).alias("n")), open_cols.groupBy("cohort_id").agg(F.count(F.lit(1)).alias("n"))
    gate = cut_lineage(n_free.join(n_open, ["cohort_id", "n"]).select("cohort_id"))
    ordered = lambda df, name: ranked_in(df.join(gate, "cohort_id", "left_semi"), ["cohort_id"], ["o", name], "p").select("cohort_id", "p", name)
    given = ordered(open_cols, "expression_id").join(ordered(free, "given"), ["cohort_id", "p"]).select("cohort_id", "expression_id", "given")
    out = matches.join(given, ["cohort_id", "expression_id"], "left")
    by_place = F.col("given").isNotNull()
    return out.select(
        *[c for c in matches.columns if c not in ("gsm_id", "match_method", "confidence")],
        F.coalesce("gsm_id", "given").alias("gsm_id"),
        F.when(by_place, "positional_fallback").otherwise(F.col("match_method")).alias("match_method"),
        F.when(by_place, F.lit(CONFIDENCE["positional_fallback"])).otherwise(F.col("confidence")).alias("confidence"),
    )


def match_status(id_map: DataFrame, cohorts: DataFrame) -> DataFrame:
    """(cohort_id, status, detail) for every cohort: not_available, matched or needs_review."""
    counts = id_map.groupBy("cohort_id").agg(F.count(F.lit(1)).alias("n"), F.count("gsm_id").alias("m"))
    detail = F.concat(F.col("m").cast("string"), F.lit("/"), F.col("n").cast("string"), F.lit(" matched"))
    return cohorts.select("cohort_id").distinct().join(counts, "cohort_id", "left").select(
        "cohort_id", F.when(F.col("n").isNull(), "not_available").when(F.col("n") == F.col("m"), "matched").otherwise("needs_review").alias("status"), F.coalesce(detail, F.lit("")).alias("detail")
    )
