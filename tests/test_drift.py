import json
from datetime import datetime

import pytest

from cohortloom.operators import drift
from cohortloom.operators.drift import _canon, flood, match_fields, payload_cells, schema_changes
from cohortloom.operators.drift_table import last_names, unified_samples

SCHEMA = "row_id long, file_id long, gse_id string, release_no int, gsm_id string, received_at timestamp_ntz, payload string, field string, canon string"
CLUSTERS = "cluster_id long, canonical_name string, source_columns array<string>, notes string"
T = datetime(2020, 1, 1)


def frame(spark, files):
    """files: (file_id, gse_id, release, {sample: payload or text})"""
    rows = [(i, f, g, n, s, T, p if p is None or isinstance(p, str) else json.dumps(p), "clash", "clash") for i, (f, g, n, recs) in enumerate(files) for s, p in recs.items()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def clusters(spark):
    return spark.createDataFrame([(1, "sex", ["gender", "Sex"], None), (2, "age", ["age_yrs"], None), (3, "none", None, None)], CLUSTERS)


def run(spark, files, clusters):
    return {tuple(r) for r in schema_changes(frame(spark, files), clusters).collect()}


def values(key, vs):
    return {f"S{i}": ({key: v} if v is not ... else {}) for i, v in enumerate(vs)}


def merge(*parts):
    out = {}
    for p in parts:
        for s, rec in p.items():
            out.setdefault(s, {}).update(rec)
    return out


def test_types_come_from_the_text_of_the_json():
    kinds = {c["field"]: c["kind"] for c in payload_cells('{"a": true, "b": 1, "c": 1.0, "d": "x", "e": [1], "f": null, "g": {"h": 2}, "i": {}}')}
    assert kinds == {"a": 1, "b": 2, "c": 3, "d": 4, "e": 5, "f": 0, "g.h": 2, "i": 0}
    assert payload_cells(None) == payload_cells("not json") == payload_cells("[1]") == payload_cells("") == []


def test_codings_have_one_form():
    assert _canon(True) == _canon("yes") == _canon(1) == _canon("1.0")
    assert _canon(["A", "B"]) == _canon("A; B") == _canon("a,b")
    assert _canon("62 yrs") == _canon(62.0) == _canon("62")


def test_changes(spark, clusters):
    one = merge(values("age_yrs", [61, 40, 75, 88]), values("notes", ["a 1", "b 2", "c 3", "d 4"]), values("bmi", [20, 21, 22, 23]), values("old", [1, 2, 3, 5]))
    two = merge(values("age", ["61", "40", "75", None]), values("remark", ["a 1", "b 2", ..., "d 4"]), values("bmi", [20.0, 21.0, 22.0, 23.0]), values("new", ["u", "v", "u", "v"]))
    got = run(spark, [(7, "G", 1, one), (8, "g ", 3, two), (9, "G", 4, two), (10, "H", 1, one)], clusters)
    assert got == {(8, "renamed", "age_yrs", "age"), (8, "retyped", "age_yrs", "age"), (8, "renamed", "notes", "remark"), (8, "retyped", "bmi", "bmi"), (8, "removed", "old", ""), (8, "added", "", "new")}


def test_recoded_rename(spark, clusters):
    vs = ["F", "M", "M", "F", "M", "F", "F", "M"]
    got = run(spark, [(1, "G", 1, values("gender", vs)), (2, "G", 2, values("Sex", [1 if v == "M" else 2 for v in vs]))], clusters)
    assert got == {(2, "renamed", "gender", "Sex"), (2, "retyped", "gender", "Sex")}


def test_unlike_fields_are_no_rename(spark, clusters):
    got = run(spark, [(1, "G", 1, values("organ", ["a", "b", "c", "d", "a"])), (2, "G", 2, values("wbc", [4.5, 2.0, 9.1, 3.3, 7.0]))], clusters)
    assert got == {(2, "removed", "organ", ""), (2, "added", "", "wbc")}


def test_nulls_repeats_and_broken_payloads(spark, clusters):
    rec = values("x", [1, 2, 3])
    files = [(1, "G", 1, rec), (1, "G", 1, rec), (2, "G", 2, merge(values("x", [None, None, None]), values("y", [None, None, None]))), (3, "G", 3, {"S0": None, "S1": "{", "S2": '{"x": "a"}'})]
    got = run(spark, files, clusters)
    assert got == {(2, "added", "", "y"), (3, "removed", "y", "")}
    assert schema_changes(frame(spark, files).limit(0), clusters).collect() == []


def pair(old, new, both=0, equal=0, pairs=0, mutual=0, entropy=0.0, kinds=(4, 4)):
    return {"old": old, "new": new, "old_kind": kinds[0], "new_kind": kinds[1], "n_both": both, "n_equal": equal, "n_pairs": pairs, "n_mutual": mutual, "entropy": entropy}


def test_flooding_converges_and_prefers_agreement():
    good, bad = dict(both=9, equal=9, pairs=5, mutual=9, entropy=2.0), dict(both=9, equal=1, pairs=9, mutual=3, entropy=2.0)
    pairs = [pair("age_yrs", "age", **good), pair("age_yrs", "wbc", **bad), pair("leuk", "wbc", **good), pair("leuk", "age", **bad)]
    scores = flood(pairs, {})
    assert scores[("age_yrs", "age")] > scores[("age_yrs", "wbc")] and scores[("leuk", "wbc")] > scores[("leuk", "age")]
    assert all(v >= 0 for v in scores.values()) and match_fields([], {}) == []
    assert set(match_fields(pairs, {})) == {("age_yrs", "age"), ("leuk", "wbc")}


TWINS = [pair(a, b, 8, 8, 4, 8, 2.0) for a in ("a_start", "b_stop") for b in ("start", "stop")]
RETYPED = [pair("x", "n", 8, 8, 2, 8, 1.0, (2, 2)), pair("x", "m", 8, 8, 2, 8, 1.0, (2, 4)), pair("y", "n", 8, 8, 2, 8, 1.0, (4, 2)), pair("y", "m", 8, 8, 2, 8, 1.0, (4, 4))]
NESTED = [pair("p.a", "q.k", 9, 9, 9, 9, 3.2), pair("p.a", "r.z", 9, 0, 9, 0, 3.2)] + [pair("p.b", n, 2, 2, 2, 2, 1.0) for n in ("r.l", "q.m")]


def test_names_types_and_nesting_decide_between_like_values():
    assert set(match_fields(TWINS, {})) == {("a_start", "start"), ("b_stop", "stop")}
    assert set(match_fields(RETYPED, {})) == {("x", "n"), ("y", "m")}
    assert ("p.b", "q.m") in match_fields(NESTED, {})
    known = {"sex": 1, "gender": 1}
    constant = [pair("sex", "gender", 5, 0, 1, 5, 0.0), pair("sex", "smoker", 5, 0, 1, 5, 0.0)]
    assert match_fields(constant, known) == [("sex", "gender")] and match_fields(constant[1:], known) == []


@pytest.mark.parametrize("level", [0.0, 1.0])
def test_without_flooding_other_fields_correspond(monkeypatch, level):
    monkeypatch.setattr(drift, "flood", lambda pairs, concepts: {(p["old"], p["new"]): level for p in pairs})
    assert {a for a, _ in match_fields(TWINS[::-1], {})} != {"a_start", "b_stop"} or level
    assert ("p.b", "q.m") not in match_fields([*NESTED[:2], pair("p.b", "a.l", 2, 2, 2, 2, 1.0), NESTED[3]], {})
    assert match_fields([pair("sex", "smoker", 5, 0, 1, 5, 0.0)], {}) == ([("sex", "smoker")] if level else [])


def test_one_table(spark, clusters):
    files = [(1, "G", 1, values("age_yrs", [61, 40, 75])), (2, "G", 2, values("age at dx", ["61", "40", 75.5])), (3, "G", 3, values("age at dx", [62, None, 75.5]))]
    got = {(r.gsm_key, r.field, r.value, r.value_type) for r in unified_samples(frame(spark, files), clusters).collect()}
    assert {v for s, _, v, _ in got if s == "S0"} >= {"62"} and all(t == "text" for *_, t in got if _[1] == "age at dx")


def test_values_stay_as_written(spark, clusters):
    text = ["5 mg", "5 kg", "3 months", "3 years", "120/80", "a,b", "Yes", "Mixed Case"]
    one = merge(values("note", text), values("id", [9007199254740993, True, 3]), values("dose", [1, 2.50, True]), values("list", [["A", 1.0, None], 'x/"é"', 2]), values("ok", [True, False, True]))
    got = {(r.field, int(r.gsm_key[1:])): (r.value, r.value_type) for r in unified_samples(frame(spark, [(1, "G", 1, one)]), clusters).collect()}
    assert [got["note", i] for i in range(len(text))] == [(v, "text") for v in text]
    assert [got["id", i] for i in range(3)] == [("9007199254740993", "integer"), ("1", "integer"), ("3", "integer")]
    assert [got["dose", i] for i in range(3)] == [("1", "decimal"), ("2.5", "decimal"), ("1", "decimal")]
    assert [json.loads(got["list", i][0]) for i in range(3)] == [["A", 1.0, None], ['x/"é"'], [2]] and got["list", 0] == ('["A", 1.0, null]', "list")
    assert [got["ok", i] for i in range(3)] == [("true", "boolean"), ("false", "boolean"), ("true", "boolean")]


def test_chains_and_cycles_of_renames():
    chain = [(f"n{i}", f"n{i + 1}", i) for i in range(500)]
    assert set(last_names(chain).values()) == set(last_names(chain[::-1]).values()) == {"n500"}
    assert last_names([("a", "b", 2), ("b", "a", 3)]) == {"b": "a"}
    for turn in range(3):
        cycle = [("a", "b", 2), ("b", "c", 3), ("c", "a", 4), ("x", "y", 1), ("y", "b", 2)]
        assert last_names(cycle[turn:] + cycle[:turn]) == {"b": "a", "c": "a", "x": "a", "y": "a"}
    assert last_names([]) == {}


def test_a_long_chain_is_one_field(spark, clusters):
    names = [f"name {chr(97 + i)}" for i in range(21)]
    files = [(i + 1, "G", i + 1, values(name, [f"v{k}" for k in range(4)])) for i, name in enumerate(names)]
    assert {r.field for r in unified_samples(frame(spark, files), clusters).collect()} == {names[-1]}
