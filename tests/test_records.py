import json
import os

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import records as R
from cohortloom.plans import providers as P
from cohortloom.sinks import tables as T

META = "path string, gse_id string, entity string, entity_id string, key string, ord int, value string"


@pytest.fixture(scope="module")
def metadata(spark):
    rows = [("SERIES", "G1", "title", 0, "A title"), ("SERIES", "G1", "summary", 0, "one"), ("SERIES", "G1", "summary", 1, "two"), ("SERIES", "G1", "pubmed_id", 0, "1"), ("SERIES", "G1", "pubmed_id", 1, "2")]
    rows += [("PLATFORM", "GPL2", "technology", 0, "in situ oligonucleotide"), ("PLATFORM", "GPL2", "title", 0, "array"), ("PLATFORM", "GPL1", "title", 0, "x")]
    for i in range(3):
        s = f"S{i}"
        rows += [("SAMPLE", s, "channel_count", 0, "2" if i < 2 else "1"), ("SAMPLE", s, "organism_ch1", 0, "" if i == 0 else "Homo sapiens"), ("SAMPLE", s, "title", 0, f"t{i}")]
        rows += [("SAMPLE", s, "source_name_ch1", 0, "Universal Human Reference"), ("SAMPLE", s, "source_name_ch2", 0, "liver"), ("SAMPLE", s, "characteristics_ch1", 0, "tissue: pool"), ("SAMPLE", s, "characteristics_ch2", 0, "tissue: liver"), ("SAMPLE", s, "characteristics_ch2", 1, "sex: F")]
    return spark.createDataFrame([("p", "G1", *r) for r in rows], META)


def test_series_row(metadata):
    (r,) = R.series_rows(metadata).collect()
    assert (r.title, r.summary, r.organism, r.platforms, r.n_samples, r.pubmed_ids, r.overall_design) == ("A title", "one two", "Homo sapiens", "GPL1;GPL2", 3, "1;2", "")
    assert [(p["platform_id"], p["assay_type"]) for p in json.loads(r.platform_details)] == [("GPL1", "other"), ("GPL2", "microarray")]
    assert R.series_rows(metadata.limit(0)).collect() == []


def test_sample_rows(metadata):
    got = {r.gsm_id: r for r in R.sample_rows(metadata).collect()}
    assert got["S0"].characteristics == {"tissue": "pool", "tissue_ch2": "liver", "sex_ch2": "F"} and got["S0"].reference_channel == 1 and got["S0"].source_name_ch2 == "liver"
    assert got["S2"].characteristics == {"tissue": "pool"} and got["S2"].reference_channel is None and got["S2"].channel_count is None
    assert R.sample_rows(metadata.where("entity <> 'SAMPLE'")).collect() == []


def test_gates_and_notes(spark):
    df = spark.createDataFrame([("Homo sapiens", ["a"], None), ("Mus musculus", [], ["f", "g"]), ("", None, []), (None, ["a", "b"], ["f"])], "o string, s array<string>, f array<string>")
    got = [tuple(r) for r in df.select(R.human_gate(F.col("o")), R.orphan_note(F.col("s"), F.col("f"))).collect()]
    assert [g for g, _ in got] == [True, False, True, True]
    assert got[2][1] == "" and "1 sample(s)" in got[0][1] and "2 supplementary file(s)" in got[1][1] and got[3][1].endswith("in no subseries: f")


def test_lists_and_summaries(spark):
    report = spark.createDataFrame([("G2",), (None,), ("G1",), (" ",), ("G3",), ("G3",)], "gse_id string").coalesce(1)
    assert [r.gse_id for r in R.requested_ids(["G1", "G9"], report).orderBy("ord").collect()] == ["G1", "G9", "G2", "G3"]
    df = spark.createDataFrame([("10", "x"), ("9.5", "x"), ("n", "y"), (None, None)] + [(str(i), "z") for i in range(20, 30)], "a string, b string")
    got = {r.column_name: (r.low, r.high, r.examples) for r in R.numeric_summaries(df, ["a", "b"]).collect()}
    assert got == {"a": (9.5, 29.0, "10; 20; 21; 22; 23"), "b": (None, None, "x; y; z")}
    dropped = spark.createDataFrame([("TP53", 1), ("X", 2)], "symbol string, n int")
    assert [r.symbol for r in R.listed_dropped(dropped, spark.createDataFrame([("TP53",), ("TP53",)], "symbol string")).collect()] == ["TP53"]


def test_channels(spark):
    cells = spark.createDataFrame([("c", "p1", "s", 1, 2.0), ("c", "p2", "s", 1, 4.0), ("c", "p1", "s", 2, 8.0), ("d", "p1", "s", 1, 1.0)], "cohort_id string, feature_id string, sample_id string, channel int, value double")
    probes = spark.createDataFrame([("p1", "G", None), ("p2", "G", None)], "probe_id string, gene_symbol string, entrez_id string")
    calls = spark.createDataFrame([("c", 2), ("d", None)], "cohort_id string, signal_channel int")
    got = {(r.cohort_id, r.role, r.feature_id): r.value for r in R.channel_matrices(cells, probes, calls).collect()}
    assert got == {("c", "ch1", "G"): 3.0, ("c", "reference", "G"): 3.0, ("c", "ch2", "G"): 8.0, ("c", "signal", "G"): 8.0, ("d", "ch1", "G"): 1.0}


def test_tables_by_cohort(spark, tmp_path):
    path, rows = str(tmp_path / "t"), lambda df: sorted((r.gse_id, r.v) for r in df.select("gse_id", "v").collect())
    make = lambda *data: spark.createDataFrame(list(data), "gse_id string, v int")
    assert T.read_or_none(spark, path) is None
    T.write_cohorts(make(("A", 1), ("B", 2)), path)
    T.write_cohorts(make(("B", 3), ("C", 4)), path)
    assert rows(T.read_or_none(spark, path)) == [("A", 1), ("B", 3), ("C", 4)]
    for _ in range(2):
        T.append_new(make(("A", 9), ("D", 5)), path)
    assert rows(spark.read.parquet(path)) == [("A", 1), ("B", 3), ("C", 4), ("D", 5)]
    T.write_facts(spark.createDataFrame([("A", "x"), ("B", "")], "gse_id string, note string"), path + "f", ["note"])
    assert spark.read.parquet(path + "f").count() == 1
    T.write_harmonized(make(("A", 1)), make(("A", 1)).limit(0), path + "h")
    assert os.listdir(path + "h") == ["cohorts"]
    calls = []
    build = lambda: calls.append(1) or make(("A", 7))
    for _ in range(2):
        assert T.cached(spark, path + "c", "gse_id string, v string", build).first()["v"] == "7"
    assert len(calls) == 1
    T.export_text(spark.createDataFrame([("A", ["x", "y"])], "gse_id string, l array<string>"), path + "e")
    assert spark.read.option("sep", "\t").option("header", True).csv(path + "e").first()["l"] == "x;y"
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.txt").write_bytes(b"abc")
    manifest = spark.createDataFrame([("a.txt", "BA7816BF8F01CFEA414140DE5DAE2223B00361A396177A9CB410FF61F20015AD"), ("b.txt", "00")], "file string, sha256 string")
    assert [(r.file, r.found) for r in T.wrong_checksums(spark, str(tmp_path / "src"), manifest).collect()] == [("b.txt", None)]


def test_answers_and_vocabularies(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("AML biopsies", "sorted by FACS, RNA-seq of bone tissue", "Homo sapiens", None), ("x", None, None, "in situ oligonucleotide")], "t string, s string, o string, k string")
    one, two = (r.c for r in df.select(P.rule_classes(F.col("t"), F.col("s"), F.col("o"), F.col("k"), "AML", ["leukemia"]).alias("c")).collect())
    assert one.asDict() == {"matches_diagnosis": True, "diagnosis_detail": "AML", "species": "human", "sample_type": "biopsy", "tissue_class": "tissue", "assay_type": "bulk_rnaseq", "selection_method": "FACS_sorting", "notes": ""}
    assert (two.matches_diagnosis, two.assay_type, two.species) == (False, "microarray", "unknown") and two.notes.startswith("not told: species, sample_type")
    assert P.seed_hints("a CLL SLL cohort") == ["CLL_SLL: IGHV_status is one of mutated, unmutated"] and P.seed_hints("unknown") == P.seed_hints("") == []
    assert P.loaded("diagnoses", ["a"]) == ["a"]
    (tmp_path / "diagnoses.json").write_text('["b"]')
    monkeypatch.setenv("COHORTLOOM_VOCABULARY", str(tmp_path))
    assert P.loaded("diagnoses", ["a"]) == ["b"] and P.loaded("aliases", {}) == {}
    groups, known = spark.createDataFrame([("f1",), ("f1",), ("f2",), ("f3",)], "fingerprint_id string"), spark.createDataFrame([("f1", "kept"), ("f9", "old")], "fingerprint_id string, a string")
    asked = lambda g: g.withColumn("a", F.lit("new"))
    assert {tuple(r) for r in P.answered(groups, asked, known=known).collect()} == {("f1", "kept"), ("f2", "new"), ("f3", "new")}
    assert P.answered(groups, asked).count() == 3
