"""Per-key results when a handful of keys hold most rows.

Rows are range partitioned by the composite (key, secondary order).  Spark takes
the range bounds from sampled quantiles of that composite, so a key that holds a
third of all rows is cut into as many ranges as its share asks for.  Each
partition is then one sorted stretch: it is folded in a single pass to one
partial state per key it touches, and the states of a key that was cut are
stitched in the order of the secondary column.  What crosses the second
shuffle is one row for each key and partition, however many rows a key has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.keys import normal_key, wall_micros
from cohortloom.session import ship

_STATE = (
    "key_field string, key_text string, n_rows long, n_keyed long, n_runs long, n_age long, sum_age double,"
    " first_us long, last_us long, widest_us long, head_text string, head_us long, tail_text string, tail_us long"
)


_NAMES = [part.split()[0] for part in _STATE.split(",")]
_KINDS = {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}
_TYPES = [_KINDS[part.split()[1]] for part in _STATE.split(",")]
_NONE = np.iinfo(np.int64).min


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One state per key of a sorted partition; a key that spans batches keeps one state."""
    pending: dict | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        states = _states(batch)
        first = {n: v[0] for n, v in states.items()}
        if pending is not None and (pending["key_field"], pending["key_text"]) == (first["key_field"], first["key_text"]):
            for n, v in _join(pending, first).items():
                states[n][0] = v
        elif pending is not None:
            yield _batch({n: [v] for n, v in pending.items()})
        pending = {n: v[-1] for n, v in states.items()}
        if len(states["n_rows"]) > 1:
            yield _batch({n: v[:-1] for n, v in states.items()})
    if pending is not None:
        yield _batch({n: [v] for n, v in pending.items()})


def _batch(states: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(states[n], t) for n, t in zip(_NAMES, _TYPES, strict=True)], _NAMES)


def _changes(column: pa.Array) -> np.ndarray:
    """Of each value but the first, whether it differs from the one before (null equals null)."""
    before, after = column.slice(0, len(column) - 1), column.slice(1)
    differ = pc.fill_null(pc.not_equal(before, after), False).to_numpy(zero_copy_only=False)
    return differ | (before.is_null().to_numpy(zero_copy_only=False) != after.is_null().to_numpy(zero_copy_only=False))


def _states(batch: pa.RecordBatch) -> dict[str, list]:
    """The states of all keys of one sorted batch, by column."""
    rows = batch.num_rows
    field, text, item, us, amount = (batch.column(n) for n in ("key_field", "key_text", "item", "at_us", "amount"))
    new_key = np.concatenate([[True], _changes(field) | _changes(text)])
    starts = np.flatnonzero(new_key)
    ends = np.append(starts[1:], rows) - 1
    known, timed = (x.is_valid().to_numpy(zero_copy_only=False) for x in (item, us))
    at = pc.fill_null(us, 0).to_numpy(zero_copy_only=False)
    same = np.concatenate([[False], ~_changes(item)]) & known & ~new_key
    both = same & timed & np.concatenate([[False], timed[:-1]])
    gap = np.where(both, at - np.concatenate([[0], at[:-1]]), _NONE)
    has_amount = amount.is_valid().to_numpy(zero_copy_only=False)
    total = lambda x: np.add.reduceat(x.astype(np.int64), starts).tolist()
    shown = lambda x: [None if v in (_NONE, -_NONE - 1) else v for v in x.tolist()]
    n_rows, n_keyed = total(np.ones(rows)), total(known)
    heads = ends - np.array(n_keyed) + 1  # nulls come first in a key
    held = [n > 0 for n in n_keyed]
    edge = lambda column, places: [v if h else None for v, h in zip(column.take(pa.array(np.minimum(places, rows - 1))).to_pylist(), held, strict=True)]
    return {
        "key_field": field.take(pa.array(starts)).to_pylist(),
        "key_text": text.take(pa.array(starts)).to_pylist(),
        "n_rows": n_rows,
        "n_keyed": n_keyed,
        "n_runs": total(known & ~same),
        "n_age": total(has_amount),
        "sum_age": np.add.reduceat(pc.fill_null(amount, 0.0).to_numpy(zero_copy_only=False), starts).tolist(),
        "first_us": shown(np.minimum.reduceat(np.where(timed, at, -_NONE - 1), starts)),
        "last_us": shown(np.maximum.reduceat(np.where(timed, at, _NONE), starts)),
        "widest_us": shown(np.maximum.reduceat(gap, starts)),
        "head_text": edge(item, heads),
        "head_us": edge(us, heads),
        "tail_text": edge(item, ends),
        "tail_us": edge(us, ends),
    }


def _join(left: dict, right: dict) -> dict:
    """The state of two neighbouring stretches of one key, left before right."""
    pick = lambda f, a, b: b if a is None else a if b is None else f(a, b)
    meets = left["tail_text"] is not None and left["tail_text"] == right["head_text"]
    across = right["head_us"] - left["tail_us"] if meets and None not in (right["head_us"], left["tail_us"]) else None
    out = dict(left)
    for name in ("n_rows", "n_keyed", "n_runs", "n_age", "sum_age"):
        out[name] = left[name] + right[name]
    out["n_runs"] -= int(meets)
    out["first_us"] = pick(min, left["first_us"], right["first_us"])
    out["last_us"] = pick(max, left["last_us"], right["last_us"])
    out["widest_us"] = pick(max, pick(max, left["widest_us"], right["widest_us"]), across)
    if left["head_text"] is None:
        out["head_text"], out["head_us"] = right["head_text"], right["head_us"]
    if right["tail_text"] is not None:
        out["tail_text"], out["tail_us"] = right["tail_text"], right["tail_us"]
    return out


def keyed_stretches(
    df: DataFrame, key_fields: list[str], item: str = "gsm_id", at: str = "loaded_at", amount: str = "age"
) -> DataFrame:
    """One row for each row and key field that has a key: (key_field, key_text, item, at_us, tie, amount).

    ``tie`` is a hash of row_id where there is one: rows alike in all else can then still be cut apart.
    """
    tie = F.xxhash64("row_id") if "row_id" in df.columns else F.lit(0).cast("long")
    pairs = F.array(*[F.struct(F.lit(name).alias("key_field"), normal_key(F.col(name)).alias("key_text")) for name in key_fields])
    return df.select(
        F.explode(F.filter(pairs, lambda p: p["key_text"].isNotNull())).alias("k"),
        normal_key(F.col(item)).alias("item"),
        wall_micros(F.col(at)).alias("at_us"),
        tie.alias("tie"),
        F.col(amount).cast("double").alias("amount"),
    ).select("k.key_field", "k.key_text", "item", "at_us", "tie", F.when(~F.isnan("amount"), F.col("amount")).alias("amount"))


def per_key_summary(
    df: DataFrame, key_fields: list[str], item: str = "gsm_id", at: str = "loaded_at", amount: str = "age", partitions: int | None = None
) -> DataFrame:
    """Counts, distinct items, re-deliveries and times of every key of every key field.

    Columns: key_field, key_text (trimmed, upper case), n_rows, n_samples (distinct
    items), n_redelivered (rows with an item beyond its first), mean_age (null
    without ages), first_us / last_us (microseconds), widest_gap_us (longest time
    between two deliveries of one item next to each other in time; null without any).

    Nulls and null marks in a key field give no row; a null item counts in
    n_rows only; null times and amounts are left out of their figures.  Ties in
    time don't matter to any figure.  An empty table gives no rows.  Columns of
    ``df`` other than those named are not read.
    """
    ship(df.sparkSession)
    rows = keyed_stretches(df, key_fields, item, at, amount)
    order = ["key_field", "key_text", "item", "at_us", "tie"]
    ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    states = ranged.sortWithinPartitions(*order).mapInArrow(_fold, _STATE)
    # All states of a key: one a partition that holds a part of it.  Their order is that of the secondary column; a
    # part without items comes first, as nulls do in the range order.
    parts = F.sort_array(F.collect_list(F.struct(F.coalesce("head_text", F.lit("")).alias("at_text"), F.coalesce("head_us", F.lit(-(2**62))).alias("at_us"), "head_text", "head_us", "tail_text", "tail_us")))
    edges = F.zip_with(
        F.slice("parts", 1, F.greatest(F.size("parts") - 1, F.lit(0))),
        F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0))),
        lambda a, b: F.when(a["tail_text"] == b["head_text"], F.struct(F.lit(1).alias("met"), (b["head_us"] - a["tail_us"]).alias("gap"))),
    )
    total = states.groupBy("key_field", "key_text").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_keyed", "n_runs", "n_age", "sum_age")],
        F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"),
        F.max("widest_us").alias("widest_us"),
        parts.alias("parts"),
    )
    met = total.withColumn("edges", F.filter(edges, lambda e: e.isNotNull()))
    return met.select(
        "key_field",
        "key_text",
        "n_rows",
        (F.col("n_runs") - F.size("edges")).alias("n_samples"),
        (F.col("n_keyed") - F.col("n_runs") + F.size("edges")).alias("n_redelivered"),
        F.try_divide("sum_age", "n_age").alias("mean_age"),
        "first_us",
        "last_us",
        F.greatest("widest_us", F.array_max(F.transform("edges", lambda e: e["gap"]))).alias("widest_gap_us"),
    )


def heavy_keys(df: DataFrame, key_fields: list[str], share: float = 0.03, **columns) -> DataFrame:
    """Keys with at least ``share`` of all rows of ``df``, rows without a key included in the total."""
    total = df.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return per_key_summary(df, key_fields, **columns).where(F.col("n_rows") >= F.lit(share) * total).select("key_field", "key_text")
