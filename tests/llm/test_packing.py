import random
from collections import defaultdict

import pytest

import cohortloom.llm.packing as packing
from cohortloom.llm.packing import pack, plan


def test_plans_place_everything_and_fit():
    rng = random.Random(0)
    for _ in range(300):
        capacity = rng.choice([1, 2, 7, 30, 100])
        counts = {s: rng.randint(0, 9) for s in rng.sample(range(1, capacity + 1), min(capacity, 12))}
        steps, bins = plan(counts, capacity)
        used, placed = [0] * bins, defaultdict(int)
        for size, n, first, each in steps:
            placed[size] += n
            for i in range(n):
                used[first + i // each] += size
        assert dict(placed) == {s: n for s, n in counts.items() if n}
        assert all(0 < u <= capacity for u in used)


def test_plan_is_near_the_bound():
    rng = random.Random(2)
    counts = defaultdict(int)
    for _ in range(20_000):
        counts[min(2048, max(1, int(rng.lognormvariate(5.3, 0.9))))] += 1
    assert plan(counts, 2048)[1] <= 1.01 * sum(s * n for s, n in counts.items()) / 2048 + 1


@pytest.mark.parametrize("group", [200_000, 7])
def test_frames(spark, monkeypatch, group):
    monkeypatch.setattr(packing, "RANK_GROUP", group)
    data = [(1, None), (2, 0), (3, 10), (4, 10), (5, 10), (6, 25), (7, 7), (8, 3), (9, 10), (9, 10)] + [(100 + i, 3) for i in range(40)]
    df = spark.createDataFrame([(a, b, "clash") for a, b in data], "doc_id long, n_tokens int, size string")
    rows = pack(df, 10).collect()
    used = defaultdict(int)
    for r in rows:
        used[r.container_id] += r.n_tokens
        assert r.n_tokens == r.token_to - r.token_from
    assert max(used.values()) <= 10 and len(rows) == len(data) + 2
    assert sorted((r.piece_no, r.token_from, r.token_to) for r in rows if r.doc_id == 6) == [(0, 0, 10), (1, 10, 20), (2, 20, 25)]
    assert sum(used.values()) == sum(b or 0 for _, b in data)
    assert pack(df.limit(0), 10).collect() == []
    assert {r.container_id for r in pack(spark.createDataFrame([(1, 0), (2, None)], "doc_id long, n_tokens int"), 10).collect()} == {0}
