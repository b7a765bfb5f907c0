import random
from datetime import datetime, timedelta

from cohortloom.operators.orphans import orphan_references, reference_counts
from cohortloom.streaming.reference_counts import batch_writer, latest, merged, orphans

T0 = datetime(2020, 1, 15)
REF = "row_id long, gse_id string, loaded_at timestamp_ntz, switches string, first_us long"
TARGET = "gse_id string, loaded_at timestamp_ntz, removed_at timestamp_ntz, ref_key string"


def norm(k):
    return None if k is None or k.strip().upper() in ("", "---", "NONE") else k.strip().upper()


def brute(refs, targets):
    out = set()
    for i, k, t, *_ in refs:
        k = norm(k)
        own = [x for x in targets if norm(x[0]) == k]
        if k is None:
            continue
        if not own:
            out.add(("r", i, t and t.strftime("%Y-%m"), "missing"))
        elif t and not any((a is None or a <= t) and (b is None or b > t) and not (a and b and b <= a) for _, a, b, _ in own):
            first = min((a or datetime.min) for _, a, _, _ in own)
            out.add(("r", i, t.strftime("%Y-%m"), "late" if first > t else "deleted"))
    return out


def test_equals_brute_force(spark):
    for seed in range(3):
        rng = random.Random(seed)
        day = lambda: rng.choice([None, *[T0 + timedelta(days=rng.randrange(90)) for _ in range(9)]])  # noqa: B023, E731
        keys = ["a", "A ", " b", "c", "d\t", "", "---", None, "e"]
        targets = [(rng.choice(keys[:8]), day(), day(), "clash") for _ in range(40)]
        refs = [(i, rng.choice(keys), day(), "clash", 1) for i in range(120)]
        got = orphan_references(spark.createDataFrame(refs, REF), "r", "gse_id", spark.createDataFrame(targets, TARGET), "gse_id")
        assert {tuple(r) for r in got.collect()} == brute(refs, targets)


def test_bounds_of_force(spark):
    """In force from loaded_at until just before removed_at; a row removed at once never is."""
    t = lambda d: T0 + timedelta(days=d)
    targets = spark.createDataFrame([("k", t(5), t(9), ""), ("v", t(1), t(1), "")], TARGET)
    refs = spark.createDataFrame([(1, "K", t(4), "", 0), (2, "k", t(5), "", 0), (3, "k", t(9), "", 0), (4, "v", t(2), "", 0), (5, "x", None, "", 0), (6, "k", None, "", 0)], REF)
    got = {(r.row_id, r.orphan_kind) for r in orphan_references(refs, "r", "gse_id", targets, "gse_id").collect()}
    assert got == {(1, "late"), (3, "deleted"), (4, "deleted"), (5, "missing")}


def test_empty_tables(spark):
    none, refs = spark.createDataFrame([], TARGET), spark.createDataFrame([(1, "k", T0, "", 0)], REF)
    assert orphan_references(refs.limit(0), "r", "gse_id", none, "gse_id").collect() == []
    assert [r.orphan_kind for r in orphan_references(refs, "r", "gse_id", none, "gse_id").collect()] == ["missing"]


def test_counts_and_stream_agree(spark, tmp_path):
    targets = spark.createDataFrame([("k", T0, None, ""), ("g", T0, T0 + timedelta(days=1), "")], TARGET)
    refs = spark.createDataFrame([(1, "k", T0, "", 0), (2, "g", T0, "", 0), (3, "m", T0, "", 0), (4, "m", T0, "", 0)], REF)
    now = {(r.ref_key, r.n_refs, r.n_alive) for r in reference_counts(refs, "gse_id", targets, "gse_id").collect()}
    assert now == {("K", 1, 1), ("G", 1, 0), ("M", 2, 0)}
    write = batch_writer(str(tmp_path / "state"))
    batches = [[("K", 1, 0), ("K", 0, 1), ("G", 1, 0), ("G", 0, 1)], [("G", 0, -1), ("M", 1, 0), ("M", 1, 0), (None, 1, 0)]]
    for i, b in enumerate(batches):
        df = spark.createDataFrame(b, "ref_key string, refs long, alive long")
        write(df, i)
        write(df, i)  # run again after a failure: no double counting
    state = latest(spark, str(tmp_path / "state"))
    assert {tuple(r) for r in state.collect()} == {("K", 1, 1), ("G", 1, 0), ("M", 2, 0)}
    assert {tuple(r) for r in orphans(state).collect()} == {("G", 1), ("M", 2)}
    assert merged(state, spark.createDataFrame([("G", -1, 0)], "ref_key string, refs long, alive long")).where("ref_key = 'G'").count() == 0


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    path, schema = str(tmp_path / "state"), "ref_key string, refs long, alive long"
    write = batch_writer(path, 8)
    write(spark.createDataFrame([(f"k{i}", 1, 0) for i in range(60)], schema), 0)
    for batch in range(1, 6):
        write(spark.createDataFrame([("k1", 1, 0), ("k2", -1 if batch == 1 else 0, 0)], schema), batch)
    rewritten = [f.name for f in (tmp_path / "state" / "version=5").iterdir() if f.name.startswith("bucket=")]
    assert 1 <= len(rewritten) <= 2
    assert {f.name for f in (tmp_path / "state").iterdir() if f.name.startswith("version=")} == {"version=0", "version=4", "version=5"}
    state = {r.ref_key: r.refs for r in latest(spark, path).collect()}
    assert len(state) == 59 and state["k1"] == 6 and "k2" not in state and state["k3"] == 1
    assert {r.ref_key: r.refs for r in latest(spark, path, 5).collect()}["k1"] == 5
    write(spark.createDataFrame([], schema), 6)
    assert latest(spark, path).count() == 59 and latest(spark, str(tmp_path / "none")).count() == 0
