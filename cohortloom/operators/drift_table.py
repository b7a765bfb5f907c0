"""One consistent sample table out of files whose schemas drift."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.drift import TYPES, file_fields, schema_changes
from cohortloom.session import cut_lineage, ship


def last_names(steps: list[tuple[str, str, int]]) -> dict[str, str]:
    """The name that the renames (name, next name, time) of one cohort lead to at last, for each renamed name.

    A name has one next name.  A cycle of any length ends at the name that its latest
    rename gave, so that name is none of the renamed.
    """
    after = {name: following for name, following, _ in steps}
    at = {name: time for name, _, time in steps}
    last: dict[str, str] = {}
    for start in list(after):
        path, place, name = [], {}, start
        while name in after and name not in last:
            if name in place:
                latest = max(path[place[name] :], key=lambda n: (at[n], n))
                end = after[latest]
                del after[end]
                name = end
                break
            place[name] = len(path)
            path.append(name)
            name = after[name]
        end = last.get(name, name)
        last.update((n, end) for n in path if n != end)
    return last


def _cast(raw: Column, kind: Column, widest: Column) -> Column:
    """A value as written, in the text of a wider type."""
    integer, decimal, text, listed = (F.lit(TYPES.index(t)) for t in ("integer", "decimal", "text", "list"))
    truth = (kind == TYPES.index("boolean")) & widest.isin(integer, decimal)
    item = F.when(kind == text, F.to_json(F.array(raw))).otherwise(F.concat(F.lit("["), raw, F.lit("]")))
    return F.when(truth, F.when(raw == "true", "1").otherwise("0")).when((widest == listed) & (kind != listed), item).otherwise(raw)


def unified_samples(records: DataFrame, clusters: DataFrame) -> DataFrame:
    """(gse_key, gsm_key, field, value, value_type, n_files, last_release): the values of all files under one field name.

    A field's name is its cluster's canonical name where known, else the last name a
    chain of renames leads to.  Of several files with a value the one of the highest
    release counts, as it is written there and cast to the widest type of the field
    in the cohort: true and false are 1 and 0 among numbers, a single value among lists is
    a list of one, in JSON.  Null values give no row; records without a sample key give none.
    """
    ship(records.sparkSession)
    decoded = cut_lineage(file_fields(records))
    changes = cut_lineage(schema_changes(records, clusters, decoded))
    fields = decoded.where("canon is not null and gsm_key is not null")
    known = clusters.select("canonical_name", F.explode(F.concat(F.array("canonical_name"), F.coalesce("source_columns", F.array()))).alias("name")).where("name is not null")
    known = known.groupBy(F.lower("name").alias("name")).agg(F.min("canonical_name").alias("canonical"))
    where = fields.select("gse_key", "file_id", "release_no").distinct()
    renames = changes.where("drift = 'renamed'").join(where, "file_id").select("gse_key", F.col("release_no").alias("changed_at"), F.col("old_name").alias("field"), "new_name")
    # Each name's successor in its cohort; the renames of a cohort are as many as its names, not its records.
    step = renames.groupBy("gse_key", "field").agg(F.max_by("new_name", F.struct("changed_at", "new_name")).alias("next"), F.max("changed_at").alias("at"))

    @F.pandas_udf("array<struct<field:string,next:string>>")
    def resolved(steps: pd.Series) -> pd.Series:
        return steps.map(lambda rows: [{"field": a, "next": b} for a, b in last_names([(r["field"], r["next"], r["at"]) for r in rows]).items()])

    step = step.groupBy("gse_key").agg(F.sort_array(F.collect_list(F.struct("field", "next", "at"))).alias("steps")).select("gse_key", F.explode(resolved("steps")).alias("s")).select("gse_key", "s.*")
    named = fields.join(step, ["gse_key", "field"], "left").withColumn("last_name", F.coalesce("next", "field"))
    named = named.join(known, F.lower("last_name") == known["name"], "left").withColumn("field_name", F.coalesce("canonical", "last_name"))
    values = named.groupBy("gse_key", "gsm_key", F.col("field_name").alias("field")).agg(
        F.max_by(F.struct("raw", F.col("kind").alias("raw_kind")), F.struct("release_no", "file_id", "canon", "raw", "kind")).alias("v"), F.max("release_no").alias("last_release"), F.count_distinct("file_id").alias("n_files")
    )
    widest = named.groupBy("gse_key", F.col("field_name").alias("field")).agg(F.max("kind").alias("widest"))
    name_of = F.element_at(F.array(*[F.lit(t) for t in TYPES]), F.col("widest") + 1)
    return values.join(widest, ["gse_key", "field"]).select("gse_key", "gsm_key", "field", _cast(F.col("v.raw"), F.col("v.raw_kind"), F.col("widest")).alias("value"), name_of.alias("value_type"), "n_files", "last_release")
