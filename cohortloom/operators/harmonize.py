"""Annotation tables of many cohorts made one."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.clinical import event_mapping, recist, remap_event, strip_label, time_to_months
from cohortloom.plans.schemas import ColumnCluster, ColumnMappingPlan

# Columns that tell a sample and are always kept; columns of a harmonized table that no cluster may take, and the pattern of derived ones.
PROTECTED = {"gsm_id", "gse_id", "platform_id"}
HARMONIZED = PROTECTED | {"title", "organism", "expression_status", "treatment", "treatment_detail", "response", "recist"}
HARMONIZED_PATTERN = r"(?:llm_.*|.+_(?:time|event))"
# Known names of common columns.
ALIASES = {"gender": "sex", "sex": "sex", "age": "age", "age_yrs": "age", "age (yrs)": "age", "age_years": "age", "tissue": "tissue", "organ": "tissue", "cell type": "cell_type", "cell_type": "cell_type", "celltype": "cell_type"}
#: Share of numbers from which a column is numeric; number of values from which it is no category.
NUMERIC_SHARE, MOST_CATEGORIES = 0.9, 12


def free_columns(columns: list[str]) -> list[str]:
    """The columns that a cluster may take: none that tells a sample or that harmonization made."""
    return [c for c in columns if c not in HARMONIZED and not re.fullmatch(HARMONIZED_PATTERN, c)]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, n_rows, n_distinct, n_null, numeric_share, is_constant, is_numeric, is_high_cardinality) of all columns in one pass.

    A null counts as a value of its own for is_constant, and not for the rest.
    """
    columns = columns or df.columns
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), _q(c).cast("string").alias("value")) for c in columns])).alias("c")).select("c.*")
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("value").isNotNull()
    out = counts.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.count_if(known).alias("n_distinct"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_null"),
        F.coalesce(F.sum(F.when(F.col("value").try_cast("double").isNotNull(), F.col("n"))) / F.sum(F.when(known, F.col("n"))), F.lit(0.0)).alias("numeric_share"),
    )
    return out.select(
        "*",
        (F.col("n_distinct") + (F.col("n_null") > 0).cast("int") <= 1).alias("is_constant"),
        (F.col("numeric_share") >= NUMERIC_SHARE).alias("is_numeric"),
        (F.col("n_distinct") > MOST_CATEGORIES).alias("is_high_cardinality"),
    )


def column_summary(df: DataFrame, cohort: str, columns: list[str] | None = None, k: int = 8) -> DataFrame:
    """(column_name, cohorts, examples): each column's cohorts and its k most frequent values, ties in order of the value; all free columns unless told."""
    columns = free_columns([c for c in df.columns if c != cohort]) if columns is None else columns
    long = df.select(_q(cohort).alias("cohort"), F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), _q(c).cast("string").alias("value")) for c in columns])).alias("c")).select("cohort", "c.*").where("value is not null")
    counted = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    top = counted.withColumn("r", F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("n"), "value"))).where(F.col("r") <= k)
    examples = top.groupBy("column_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "value", "n"))), lambda e: F.concat(e["value"], F.lit("="), e["n"].cast("string"))), "; ").alias("examples"))
    cohorts = long.groupBy("column_name").agg(F.array_join(F.array_sort(F.collect_set("cohort")), ";").alias("cohorts"))
    return cohorts.join(examples, "column_name")


def drop_constant(df: DataFrame, protected: set[str] = PROTECTED) -> DataFrame:
    """A table without the unprotected columns that hold one value at most."""
    free = [c for c in df.columns if c not in protected]
    if not free:
        return df
    texts = [_q(c) if t in _ORDERED or t.startswith(("decimal", "timestamp")) else F.to_json(F.struct(_q(c))) for c, t in df.dtypes if c in free]
    facts = df.agg(*[F.struct(F.min(x).eqNullSafe(F.max(x)).alias("one"), F.count(c).alias("known"), F.count(F.lit(1)).alias("n")).alias(str(i)) for i, (x, c) in enumerate(zip(texts, map(_q, free), strict=True))]).first()
    return df.drop(*[c for i, c in enumerate(free) if facts[i]["known"] == 0 or facts[i]["one"] and facts[i]["known"] == facts[i]["n"]])


# Types whose least and greatest value tell whether there is only one.
_ORDERED = {"string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date"}


def aliased(df: DataFrame, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """Known column names renamed, whatever their case; an existing canonical column is kept, sibling names are coalesced."""
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        name = aliases.get(c.lower())
        if name and c != name and name not in df.columns:
            groups.setdefault(name, []).append(c)
    out = df
    for name, cols in groups.items():
        out = out.withColumn(name, F.coalesce(*[_q(c) for c in cols])) if len(cols) > 1 else out.withColumnRenamed(cols[0], name)
        out = out.drop(*cols) if len(cols) > 1 else out
    return out


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Tables united by column name, all dynamic columns as text, absent ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.select([_q(c).cast("string").alias(c) for c in f.columns]) for f in frames])


def without_parents(df: DataFrame, parents: DataFrame, key: str = "gse_id") -> DataFrame:
    """Rows whose cohort is no parent record."""
    return df.join(parents.select(key).distinct(), key, "left_anti")


def not_in_master(ids: DataFrame, master: DataFrame, key: str = "gse_id") -> DataFrame:
    """Cohorts that the master table doesn't hold yet."""
    return ids.join(master.select(key).distinct(), key, "left_anti")


def property_counts(samples: DataFrame, filters: list[tuple[str, str]], cohort: str = "gse_id") -> DataFrame:
    """(gse_id, matches) of cohorts in which every filter (key, value) matches a sample; samples have a map ``characteristics``.

    A filter looks into the characteristic of its key, or into all of them where no
    sample of the cohort has the key; case doesn't count.
    """
    has = [F.max(F.map_contains_key("characteristics", F.lit(k))).alias(f"h{i}") for i, (k, _) in enumerate(filters)]
    flags = samples.groupBy(cohort).agg(*has)
    all_text = F.lower(F.array_join(F.map_values("characteristics"), " | "))
    rows = samples.join(flags, cohort)
    hit = [F.when(F.col(f"h{i}"), F.lower(F.coalesce(F.try_element_at("characteristics", F.lit(k)), F.lit(""))).contains(v)).otherwise(all_text.contains(v)) for i, (k, v) in enumerate(filters)]
    counted = rows.groupBy(cohort).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(h).alias(f"c{i}") for i, h in enumerate(hit)])
    texts = [F.concat(F.lit(f"{k}:{v}="), F.col(f"c{i}").cast("string"), F.lit("/"), F.col("n").cast("string")) for i, (k, v) in enumerate(filters)]
    return counted.where(reduce(lambda a, b: a & b, [F.col(f"c{i}") > 0 for i in range(len(filters))])).select(cohort, F.concat_ws("; ", *texts).alias("matches"))


def clinical_columns(df: DataFrame, plan: ColumnMappingPlan) -> DataFrame:
    """A cohort's table with treatment, treatment_detail, response and recist, and a time and event column per survival plan.

    First go the redundant columns of the plan and those with one value, never one that tells
    a sample; labels are stripped from all other texts.  Texts of several columns
    are joined by '; ', nulls skipped; a survival pair needs both columns.  Columns a plan
    uses are replaced by what is made of them, absent ones are ignored.
    """
    return clinical_annotation(df, plan)[0]


def clinical_annotation(df: DataFrame, plan: ColumnMappingPlan) -> tuple[DataFrame, list[str]]:
    """``clinical_columns`` and the notes on it: those of the plan, and events whose meaning can't be read and that stay as they are."""
    notes = [plan.notes] if plan.notes else []
    out = drop_constant(df.drop(*[c for c in plan.redundant_columns if c not in PROTECTED]))
    out = out.select([(_q(c) if c in PROTECTED or t != "string" else strip_label(_q(c))).alias(c) for c, t in out.dtypes])
    for name, cols in (("treatment", plan.treatment_columns), ("treatment_detail", plan.treatment_detail_columns)):
        cols = [c for c in cols if c in out.columns]
        if cols:
            out = _in_place_of(out, cols, {name: F.concat_ws("; ", *[_q(c).cast("string") for c in cols])})
    if plan.response_column in out.columns:
        text = _q(plan.response_column)
        out = _in_place_of(out, [plan.response_column], {"response": text, "recist": recist(text)})
    for s in plan.survival:
        if s.time_column in out.columns and s.event_column in out.columns:
            meaning, time, event = s.event_value_meaning or "", f"{s.survival_type}_time", f"{s.survival_type}_event"
            out = _in_place_of(out, [s.time_column, s.event_column], {time: time_to_months(_q(s.time_column), s.time_unit), event: remap_event(_q(s.event_column), meaning)})
            if not event_mapping(meaning):
                notes.append(f"{event}: the meaning of its values ({meaning!r}) can't be read; they are left as they are")
    return out, notes


def _in_place_of(df: DataFrame, used: list[str], made: dict[str, Column]) -> DataFrame:
    """A table with the made columns and without those they were made of."""
    return df.select(*[_q(c) for c in df.columns if c not in used and c not in made], *[v.alias(k) for k, v in made.items()])


def clustered(df: DataFrame, clusters: list[ColumnCluster]) -> DataFrame:
    """Each cluster's columns coalesced left to right under its canonical name, values mapped whatever their case.

    An existing column of the canonical name that isn't in the cluster is kept as it is.
    """
    out = df
    for c in clusters:
        cols = [x for x in c.source_columns if x in out.columns]
        if not cols or c.canonical_name in out.columns and c.canonical_name not in cols:
            continue
        value = F.coalesce(*[_q(x).cast("string") for x in cols])
        if c.value_mapping:
            table = F.create_map(*[F.lit(x) for k, v in sorted(c.value_mapping.items()) for x in (k.lower(), v)])
            value = F.coalesce(F.try_element_at(table, F.lower(F.trim(value))), value)
        out = out.withColumn("__new", value).drop(*cols).withColumnRenamed("__new", c.canonical_name)
    return out


def cluster_notes(df: DataFrame, clusters: list[ColumnCluster]) -> DataFrame:
    """(canonical_name, note, value, n_rows): what ``clustered`` leaves open, one row a finding.

    note is ``name_taken`` (an unrelated column has the canonical name; value names the
    columns left), ``several_values`` (rows with a value in more than one source column) or
    ``unmapped`` (a value the mapping doesn't cover).  Nothing is collected.
    """
    parts, have = [], set(df.columns)
    row = lambda name, note, value, n: F.struct(F.lit(name).alias("canonical_name"), F.lit(note).alias("note"), value.cast("string").alias("value"), n.cast("long").alias("n_rows"))
    for c in clusters:
        cols = [x for x in c.source_columns if x in have]
        if not cols:
            continue
        if c.canonical_name in have and c.canonical_name not in cols:
            parts.append(df.sparkSession.range(1).select(row(c.canonical_name, "name_taken", F.lit(", ".join(cols)), F.lit(0)).alias("r")))
            continue
        if len(cols) > 1:
            several = sum((_q(x).isNotNull().cast("int") for x in cols), F.lit(0)) > 1
            parts.append(df.where(several).agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(row(c.canonical_name, "several_values", F.lit(", ".join(cols)), F.col("n")).alias("r")))
        if c.value_mapping:
            value = F.coalesce(*[_q(x).cast("string") for x in cols])
            open_ = df.select(value.alias("v")).where(F.col("v").isNotNull() & ~F.lower(F.trim("v")).isin([k.strip().lower() for k in c.value_mapping]))
            parts.append(open_.groupBy("v").agg(F.count(F.lit(1)).alias("n")).select(row(c.canonical_name, "unmapped", F.col("v"), F.col("n")).alias("r")))
        have = have - set(cols) | {c.canonical_name}
    empty = df.sparkSession.createDataFrame([], "canonical_name string, note string, value string, n_rows long")
    return reduce(lambda a, b: a.unionByName(b), [p.select("r.*") for p in parts], empty)


def open_mappings(df: DataFrame, clusters: list[ColumnCluster]) -> DataFrame:
    """(canonical_name, value, n_rows): values of the clusters that still need a value mapping.

    A cluster needs none with fewer than two source columns or two distinct values, or
    where its mapping covers all of them.
    """
    known = [(c, [x for x in c.source_columns if x in df.columns]) for c in clusters]
    known = [(c, cols) for c, cols in known if len(cols) > 1]
    if not known:
        return df.sparkSession.createDataFrame([], "canonical_name string, value string, n_rows long")
    pairs = F.flatten(F.array(*[F.array(*[F.struct(F.lit(c.canonical_name).alias("canonical_name"), _q(x).cast("string").alias("value"), F.lower(F.trim(_q(x).cast("string"))).isin([k.strip().lower() for k in c.value_mapping] or [""]).alias("covered")) for x in cols]) for c, cols in known]))
    counts = df.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null").groupBy("canonical_name", "value").agg(F.count(F.lit(1)).alias("n_rows"), F.max("covered").alias("covered"))
    wanting = counts.groupBy("canonical_name").agg(F.count(F.lit(1)).alias("k"), F.bool_and("covered").alias("all")).where("k > 1 and not all").select("canonical_name")
    return counts.join(wanting, "canonical_name").select("canonical_name", "value", "n_rows")


def with_answers(annotation: DataFrame, answers: DataFrame, key: str = "gsm_id", prefix: str = "llm_") -> DataFrame:
    """Annotation rows with the ``llm_`` columns of their sample's answers; run again it gives the same table.

    Older columns with the prefix are replaced, other columns of the answers aren't taken;
    of several answers of one sample the first in order of its values holds.
    """
    taken = [c for c in answers.columns if c.startswith(prefix)]
    one = answers.groupBy(key).agg(F.min(F.struct(*[_q(c) for c in taken])).alias("__a")) if taken else answers.select(key).distinct()
    kept = [c for c in annotation.columns if not c.startswith(prefix)]
    return annotation.select(*[_q(c) for c in kept]).join(one, key, "left").select(*[_q(c) for c in kept], *[F.col(f"__a.`{c}`").alias(c) for c in taken])


def with_id_map(annotation: DataFrame, id_map: DataFrame, cohort: str = "gse_id", sample: str = "gsm_id") -> DataFrame:
    """Annotation rows with expression_id, id_match_method and id_match_confidence of their sample; run again it gives the same table.

    Of several expression columns of a sample the one of the highest confidence holds, then the first by name.
    """
    made = ["expression_id", "id_match_method", "id_match_confidence"]
    best = id_map.where(_q(sample).isNotNull()).groupBy(cohort, sample).agg(F.min(F.struct((-F.col("confidence")).alias("c"), "expression_id", "match_method", "confidence")).alias("__m"))
    kept = [c for c in annotation.columns if c not in made]
    return annotation.select(*[_q(c) for c in kept]).join(best, [cohort, sample], "left").select(
        *[_q(c) for c in kept], F.col("__m.expression_id").alias("expression_id"), F.col("__m.match_method").alias("id_match_method"), F.col("__m.confidence").alias("id_match_confidence")
    )


def fingerprint_groups(samples: DataFrame, cohort: str, sample: str, fingerprint_column: str = "fingerprint_id") -> DataFrame:
    """(cohort, fingerprint_id, n_samples, first_sample): samples of a cohort with the same characteristics.

    The members aren't collected: a group may hold any number of samples.
    """
    return samples.groupBy(cohort, fingerprint_column).agg(F.count(F.lit(1)).alias("n_samples"), F.min(sample).alias("first_sample"))


def group_answers(samples: DataFrame, answers: DataFrame, categories: list[str], details: list[str], key: str = "fingerprint_id") -> DataFrame:
    """Samples with the answers of their group; categories without one are 'unknown', details ''."""
    out = samples.join(answers.select(key, *categories, *details), key, "left")
    return out.fillna("unknown", subset=categories).fillna("", subset=details)


def vocabulary(values: DataFrame, value: str, vocabulary: DataFrame, term: str = "term") -> DataFrame:
    """Rows with the vocabulary's term of their value and whether it matched; others are 'other'."""
    terms = vocabulary.select(F.lower(F.trim(term)).alias("__k"), F.col(term).alias("__t")).groupBy("__k").agg(F.min("__t").alias("__t"))
    out = values.join(terms, F.lower(F.trim(_q(value))) == F.col("__k"), "left")
    return out.select(*[_q(c) for c in values.columns], F.coalesce("__t", F.lit("other")).alias("normalized"), F.col("__t").isNotNull().alias("matched"))
