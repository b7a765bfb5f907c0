"""References to records that do not exist, from signed counts of change deltas.

All changes are one stream: a delivery of a target record adds one to the existence count
of its key, a withdrawal takes one away, a referring row adds one to its reference count.
The running existence count of a key is built in two steps (by day, then inside the
day), so that no window holds more than one day of one key; a reference with an
existence count of zero at its own time is an orphan.  Keys without references leave the
stream before the counts are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.keys import normal_key, wall_micros

_BEGIN = -(2**62)


def existence_deltas(target: DataFrame, key: str, added: str = "loaded_at", removed: str = "removed_at") -> DataFrame:
    """(ref_key, at_us, delta, first_us): the net change of each key at each instant.

    A row without an adding time exists from the beginning; one removed at or before
    its adding time is never in force, yet its key counts as known (delta 0).
    """
    has_end = removed in target.columns
    start = F.coalesce(wall_micros(F.col(added)), F.lit(_BEGIN))
    stop = wall_micros(F.col(removed)) if has_end else F.lit(None).cast("long")
    rows = target.select(normal_key(F.col(key)).alias("ref_key"), start.alias("start"), stop.alias("stop")).where("ref_key is not null")
    void = F.coalesce(F.col("stop") <= F.col("start"), F.lit(False))
    steps = F.array(
        F.struct(F.col("start").alias("at_us"), F.when(void, 0).otherwise(1).alias("delta")),
        F.struct(F.col("stop").alias("at_us"), F.when(void, 0).otherwise(-1).alias("delta")),
    )
    return (
        rows.select("ref_key", "start", F.explode(F.filter(steps, lambda x: x["at_us"].isNotNull())).alias("d"))
        .groupBy("ref_key", F.col("d.at_us").alias("at_us"))
        .agg(F.sum("d.delta").alias("delta"), F.min("start").alias("first_us"))
    )


def change_stream(df: DataFrame, references: dict[str, str] | None = None, targets: dict[str, str] | None = None, row_id: str = "row_id", at: str = "loaded_at", removed: str = "removed_at") -> DataFrame:
    """(src_table, ref_key, at_us, alive, refs, start_us, row_id, load_month): the changes that the rows of a table make, in one scan.

    ``references`` names the reports its rows refer in and the key of each, ``targets``
    the reports its rows exist for.  A target without an adding time exists from the
    beginning; one removed at or before its adding time is never in force, yet
    its key counts as known (alive 0).
    """
    when, start = wall_micros(F.col(at)), F.coalesce(wall_micros(F.col(at)), F.lit(_BEGIN))
    stop = wall_micros(F.col(removed)) if removed in df.columns else F.lit(None).cast("long")
    void = F.coalesce(stop <= start, F.lit(False))
    none = F.lit(None).cast("long")

    def change(name: str, key: str, at_us: Column, alive: Column, refs: int, start_us: Column) -> Column:
        return F.struct(F.lit(name).alias("src_table"), normal_key(F.col(key)).alias("ref_key"), at_us.alias("at_us"), alive.cast("long").alias("alive"), F.lit(refs).cast("long").alias("refs"), start_us.alias("start_us"))

    changes = [change(name, key, when, F.lit(0), 1, none) for name, key in (references or {}).items()]
    for name, key in (targets or {}).items():
        changes.append(change(name, key, start, F.when(void, 0).otherwise(1), 0, start))
        changes.append(F.when(stop.isNotNull(), change(name, key, stop, F.when(void, 0).otherwise(-1), 0, start)))
    rows = df.select(F.col(row_id).cast("long").alias("row_id") if references else none.alias("row_id"), F.date_format(F.col(at), "yyyy-MM").alias("load_month"), F.explode(F.array_compact(F.array(*changes))).alias("c"))
    return rows.select("c.*", "row_id", "load_month").where("ref_key is not null")


def orphans_of(changes: DataFrame) -> DataFrame:
    """(src_table, row_id, load_month, orphan_kind) of a stream of changes: references at whose time the existence count of their key is zero.

    The stream is shuffled once by key and day; the sums by day have a row for each key and day.
    """
    day = F.when(F.col("at_us").isNull(), F.lit(-2)).when(F.col("at_us") == _BEGIN, F.lit(-1)).otherwise(F.floor(F.col("at_us") / F.lit(86_400_000_000)))
    dated = changes.withColumn("day", day.cast("long")).repartition("src_table", "ref_key", "day")
    by_day = dated.groupBy("src_table", "ref_key", "day").agg(F.sum("alive").alias("net"), F.sum("refs").alias("refs"), F.min("start_us").alias("first_us"))
    key = Window.partitionBy("src_table", "ref_key")
    earlier = key.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    states = by_day.select(
        "src_table", "ref_key", "day", F.col("refs").alias("day_refs"), F.coalesce(F.sum("net").over(earlier), F.lit(0)).alias("carry"), F.sum("refs").over(key).alias("n_refs"), F.min("first_us").over(key).alias("first_us")
    ).where("n_refs > 0 and day_refs > 0")
    # Changes of one instant count together: a removal at the reference's own time has happened, and so has a delivery.
    within = Window.partitionBy("src_table", "ref_key", "day").orderBy("at_us").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = dated.withColumn("inside", F.sum("alive").over(within)).where("refs > 0").join(states.drop("n_refs", "day_refs"), ["src_table", "ref_key", "day"])
    kind = (
        F.when(F.col("first_us").isNull(), "missing")
        .when(F.col("at_us").isNull(), F.lit(None))
        .when(F.col("carry") + F.col("inside") > 0, F.lit(None))
        .when(F.col("first_us") > F.col("at_us"), "late")
        .otherwise("deleted")
    )
    return counted.select("src_table", "row_id", "load_month", kind.alias("orphan_kind")).where("orphan_kind is not null")


def orphan_references(
    source: DataFrame, source_name: str, key: str, target: DataFrame, target_key: str, row_id: str = "row_id", at: str = "loaded_at"
) -> DataFrame:
    """Rows of ``source`` whose reference had no target in force at the row's own time.

    Columns: src_table, row_id, load_month (yyyy-MM), orphan_kind (``missing``: no
    target row ever has the key; ``late``: all such rows come later; ``deleted``:
    the key was in force before).  Null keys and null marks are no references.  A row
    without a time is reported (load_month null) only if its key is missing.  Repeated
    rows and repeated keys count each by itself.  Extra columns aren't read.
    """
    return orphans_of(change_stream(source, references={source_name: key}, row_id=row_id, at=at).unionByName(change_stream(target, targets={source_name: target_key})))


def reference_counts(source: DataFrame, key: str, target: DataFrame, target_key: str, added: str = "loaded_at", removed: str = "removed_at") -> DataFrame:
    """(ref_key, n_refs, n_alive): the signed counts of every referred key after all deltas.

    Keys with n_refs > 0 and n_alive = 0 are the orphans as of now.
    """
    alive = existence_deltas(target, target_key, added, removed).select("ref_key", F.lit(0).cast("long").alias("refs"), F.col("delta").cast("long").alias("alive"))
    gone = F.when(F.col(removed).isNotNull(), 0).otherwise(1) if removed in source.columns else F.lit(1)
    refs = source.select(normal_key(F.col(key)).alias("ref_key"), gone.cast("long").alias("refs"), F.lit(0).cast("long").alias("alive")).where("ref_key is not null")
    return refs.unionByName(alive).groupBy("ref_key").agg(F.sum("refs").alias("n_refs"), F.sum("alive").alias("n_alive")).where("n_refs > 0")
