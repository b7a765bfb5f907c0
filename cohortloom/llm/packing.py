"""Filling containers of a fixed capacity with documents, none split that fits.

A plan is made over the histogram of sizes, which has at most one row per size up
to the capacity whatever the number of documents: sizes above a third of the
capacity are matched greedily, at most two to a container, and smaller ones go to
the tightest remaining gap, largest size first.  A plan says, for a stretch of the
ranks of one size, which containers they go to; every document then finds its
container by its rank among the documents of its size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.tokens import TOKENIZER_DIR, token_counts
from cohortloom.session import cut_lineage, ship

#: About so many documents are ranked in one group.
RANK_GROUP = 200_000


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """(steps, number of containers) for a histogram of sizes 1..capacity.

    A step (size, n, first container, items per container) places the next n items of
    a size, so many to each container from the first on.  Runs of containers with
    one gap are kept as (first, number), so the work follows the number of
    sizes, not of items.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    steps: list[tuple[int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    open_gaps: list[int] = []
    bins = 0

    def add_gap(gap: int, first: int, number: int) -> None:
        if gap > 0 and number > 0:
            if gap not in gaps:
                gaps[gap] = []
                heapq.heappush(open_gaps, gap)
            gaps[gap].append((first, number))

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for a in large:
        while left.get(a):
            partner = next((b for b in large if b <= min(a, capacity - a) and left.get(b, 0) > (1 if a == b else 0)), None)
            if partner is None:
                n = left.pop(a)
                steps.append((a, n, bins, 1))
                add_gap(capacity - a, bins, n)
            elif partner == a:
                n = left[a] // 2
                steps.append((a, 2 * n, bins, 2))
                add_gap(capacity - 2 * a, bins, n)
                left[a] -= 2 * n
            else:
                n = min(left[a], left[partner])
                steps += [(a, n, bins, 1), (partner, n, bins, 1)]
                add_gap(capacity - a - partner, bins, n)
                left[a] -= n
                left[partner] -= n
            bins += n
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        n = left[s]
        # Gaps too small for this size may serve smaller ones; they come back after it.
        kept = []
        while n and open_gaps:
            gap = heapq.heappop(open_gaps)
            if gap < s:
                kept.append(gap)
                continue
            runs, each = gaps.pop(gap), gap // s
            while runs and n:
                first, number = runs.pop()
                full = min(number, n // each)
                if full:
                    steps.append((s, full * each, first, each))
                    add_gap(gap - s * each, first, full)
                    n -= full * each
                    first, number = first + full, number - full
                if number and n and n < each:
                    steps.append((s, n, first, n))
                    add_gap(gap - s * n, first, 1)
                    n, first, number = 0, first + 1, number - 1
                if number:
                    runs.append((first, number))
            if runs:
                if gap in gaps:
                    gaps[gap] += runs
                else:
                    gaps[gap] = runs
                    heapq.heappush(open_gaps, gap)
        for gap in kept:
            if gap in gaps:
                heapq.heappush(open_gaps, gap)
        if n:
            each = capacity // s
            full = n // each
            if full:
                steps.append((s, full * each, bins, each))
                add_gap(capacity - each * s, bins, full)
                bins += full
            if n % each:
                steps.append((s, n % each, bins, n % each))
                add_gap(capacity - (n % each) * s, bins, 1)
                bins += 1
    return steps, bins


def ranked(items: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Items with their rank from 0 among those of their size, and the number of items by size.

    Ranks are counted in hash groups of bounded size and shifted by the groups
    before, so no task sorts all items of a frequent size.
    """
    total = items.count()
    groups = max(1, -(-total // RANK_GROUP))
    grouped = items.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(groups)).cast("int"))
    counted = grouped.groupBy("size", "grp").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("size").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counted.select("size", "grp", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("size", "grp").orderBy("doc_id", "piece_no")
    out = grouped.withColumn("place", F.row_number().over(inside) - 1).join(shifts, ["size", "grp"])
    histogram = {r["size"]: r["n"] for r in counted.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    return out.select("doc_id", "piece_no", "size", (F.col("place") + F.col("shift")).alias("rank")), histogram


def pack(lengths: DataFrame, capacity: int = 2048) -> DataFrame:
    """(doc_id, piece_no, token_from, token_to, n_tokens, container_id) for (doc_id, n_tokens).

    A document longer than the capacity is cut into pieces of it and a rest; no other
    is.  Documents without tokens take no space and are spread over the containers
    (container 0 if there is no other).  Repeated doc_ids are packed each; null
    lengths count as 0; an empty table gives no rows.
    """
    ship(lengths.sparkSession)
    n = F.coalesce(F.col("n_tokens"), F.lit(0))
    cuts = F.sequence(F.lit(0), F.greatest(F.ceil(n / capacity) - 1, F.lit(0)).cast("int"))
    items = lengths.select("doc_id", n.alias("n"), F.explode(cuts).alias("piece_no")).select(
        "doc_id", "piece_no", F.least(F.col("n") - F.col("piece_no") * capacity, F.lit(capacity)).cast("int").alias("size")
    )
    placed, histogram = ranked(items)
    steps, bins = plan({s: c for s, c in histogram.items() if s > 0}, capacity)
    # Steps of one size cover its ranks without a gap; sizes follow each other on one line.
    order = sorted(range(len(steps)), key=lambda i: steps[i][0])
    base, at, starts = {}, 0, []
    for i in order:
        base.setdefault(steps[i][0], at)
        starts.append(at)
        at += steps[i][1]
    begins, firsts, eaches = np.array(starts, "int64"), np.array([steps[i][2] for i in order], "int64"), np.array([steps[i][3] for i in order], "int64")
    bases = np.zeros(capacity + 1, "int64")
    for size, value in base.items():
        bases[size] = value

    @F.pandas_udf("long")
    def container(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for size, rank in batches:
            s, r = size.to_numpy("int64"), rank.to_numpy("int64")
            out = r % max(bins, 1)
            held = s > 0
            line = bases[s[held]] + r[held]
            step = np.searchsorted(begins, line, "right") - 1
            out[held] = firsts[step] + (line - begins[step]) // eaches[step]
            yield pd.Series(out)

    return placed.select(
        "doc_id",
        "piece_no",
        (F.col("piece_no") * capacity).alias("token_from"),
        (F.col("piece_no") * capacity + F.col("size")).alias("token_to"),
        F.col("size").alias("n_tokens"),
        container("size", "rank").alias("container_id"),
    )


def pack_documents(documents: DataFrame, capacity: int = 2048, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """``pack`` of documents measured in tokens; texts are encoded once and only the lengths written."""
    return pack(cut_lineage(token_counts(documents, tokenizer, folder)), capacity)
