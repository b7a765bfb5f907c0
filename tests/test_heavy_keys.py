import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cohortloom.operators.heavy_keys import heavy_keys, keyed_stretches, per_key_summary

SCHEMA = "row_id long, gsm_id string, gse_id string, platform_id string, age double, loaded_at timestamp_ntz, key_text string, item string"
T0 = datetime(2020, 1, 1)


def brute(data, field):
    groups = defaultdict(list)
    for r in data:
        key = None if r[field] is None or r[field].strip().upper() in ("", "---", "NONE") else r[field].strip().upper()
        if key:
            groups[key].append(r)
    out = {}
    for key, rs in groups.items():
        items = defaultdict(list)
        for r in rs:
            if r["gsm_id"] is not None and r["gsm_id"].strip().upper() not in ("", "---", "NONE"):
                items[r["gsm_id"].strip().upper()].append(r["loaded_at"])
        gaps = [(b - a).total_seconds() for ts in items.values() for a, b in zip(sorted(t for t in ts if t), sorted(t for t in ts if t)[1:], strict=False)]
        out[key] = (len(rs), len(items), sum(map(len, items.values())) - len(items), max(gaps) if gaps else None)
    return out


def table(seed, n):
    rng = random.Random(seed)
    keys = ["HOT", " hot ", "Hot\t", "k1", "k2", None, "", "---", "none", "K3"]
    return [
        dict(row_id=i, gsm_id=rng.choice([None, "S1", "s1 ", "S2", "---", f"S{rng.randrange(40)}"]), gse_id=rng.choice(keys[:3] if rng.random() < 0.6 else keys), platform_id=rng.choice(keys), age=rng.choice([None, 30.0, float("nan"), 50.0]), loaded_at=None if rng.random() < 0.05 else T0 + timedelta(days=rng.randrange(300)), key_text="clash", item="clash")
        for i in range(n)
    ]


@pytest.mark.parametrize(("n", "partitions"), [(0, None), (1, 3), (400, 7), (2000, 16)])
def test_summary_equals_brute_force(spark, n, partitions):
    data = table(n, n)
    df = spark.createDataFrame([tuple(r.values()) for r in data], SCHEMA)
    got = {(r.key_field, r.key_text): (r.n_rows, r.n_samples, r.n_redelivered, None if r.widest_gap_us is None else r.widest_gap_us / 1e6) for r in per_key_summary(df, ["gse_id", "platform_id"], partitions=partitions).collect()}
    want = {(f, k): v for f in ("gse_id", "platform_id") for k, v in brute(data, f).items()}
    assert got == want


def test_a_hot_key_is_cut_and_stitched(spark):
    """One key, one sample, over many partitions: its states are stitched to one."""
    df = spark.range(3000).selectExpr("id as row_id", "'S' as gsm_id", "'K' as gse_id", "cast(null as string) as platform_id", "cast(id as double) as age", "cast(timestamp_seconds(id * id) as timestamp_ntz) as loaded_at")
    (r,) = per_key_summary(df, ["gse_id"], partitions=8).collect()
    assert (r.n_rows, r.n_samples, r.n_redelivered, r.widest_gap_us) == (3000, 1, 2999, (2999**2 - 2998**2) * 1_000_000)
    assert r.mean_age == pytest.approx(1499.5)


def test_share_counts_rows_without_key(spark):
    df = spark.createDataFrame([(i, "S", "A" if i < 3 else None, None, None, T0, "", "") for i in range(100)], SCHEMA)
    assert [tuple(r) for r in heavy_keys(df, ["gse_id", "platform_id"]).collect()] == [("gse_id", "A")]
    assert heavy_keys(df, ["gse_id"], share=0.031).collect() == []


def test_rows_alike_are_spread(spark):
    """A key whose rows differ in nothing but row_id is cut as well."""
    df = spark.range(4000).selectExpr("id as row_id", "cast(null as string) as gsm_id", "'K' as gse_id", "cast(null as double) as age", "cast(null as timestamp_ntz) as loaded_at")
    rows = keyed_stretches(df, ["gse_id"])
    order = ["key_field", "key_text", "item", "at_us", "tie"]
    sizes = [n for (n,) in rows.repartitionByRange(8, *order).groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).select("count(1)").collect()]
    assert max(sizes) < 1500
    (r,) = per_key_summary(df, ["gse_id"], partitions=8).collect()
    assert (r.n_rows, r.n_samples, r.n_redelivered, r.mean_age, r.first_us, r.widest_gap_us) == (4000, 0, 0, None, None, None)
