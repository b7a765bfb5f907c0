import pytest

from cohortloom import pipelines as V
from cohortloom.operators.matrix import median_polished
from cohortloom.operators.primary_file import primary_by_content
from cohortloom.plans.providers import FilePlans
from cohortloom.plans.schemas import ColumnCluster
from cohortloom.sources.reference import gene_reference

CATALOG = "gse_id string, title string, summary string, organism string, n_samples int"


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame([("G1", "AML cohort", "x", "Homo sapiens", 30), ("G2", "other", "of AML", "Mus musculus", 5), ("G3", "none", None, None, None)], CATALOG)


def test_search(spark, catalog):
    samples = spark.createDataFrame([("G1", {"sex": "F"}), ("G2", {"sex": "M"})], "gse_id string, characteristics map<string,string>")
    assert [r.gse_id for r in V.search(catalog, title="aml").collect()] == ["G1"]
    got = V.search(catalog, description="aml", samples=samples, properties=[V.parse_property(" Sex : m ")]).collect()
    assert [(r.gse_id, r.property_matches) for r in got] == [("G2", "sex:m=1/1")]
    with pytest.raises(ValueError):
        V.parse_property("sex")


def test_questions(catalog, tmp_path):
    got = {r.gse_id: (r.matches_diagnosis, r.species, r.meets_min_samples) for r in V.ask(catalog, "AML with at least 20 samples", FilePlans(str(tmp_path))).collect()}
    assert got == {"G1": (True, "human", True), "G2": (True, "mouse", False)}


def test_escalation(spark):
    df = spark.createDataFrame([(1, "unknown", None, "a", "b"), (2, "x", "unknown", "a", "b")], "id int, f1 string, g1 string, f2 string, g2 string")
    assert {tuple(r) for r in V.escalated(df, {"f": "f1", "g": "g1"}, {"f": "f2", "g": "g2"}).collect()} == {(1, "a", "b"), (2, "x", "unknown")}


def test_harmonize(spark):
    a = spark.createDataFrame([("1", "G1", "F", "x")], "gsm_id string, gse_id string, Gender string, coo_a string")
    b = spark.createDataFrame([("2", "G2", "y"), ("3", "G3", "z"), ("4", "G4", None)], "gsm_id string, gse_id string, coo_b string")
    master = spark.createDataFrame([("0", "G4", "old")], "gsm_id string, gse_id string, coo string")
    parents = spark.createDataFrame([("G3",)], "gse_id string")
    got = {(r.gsm_id, r.gse_id, r.sex, r.coo) for r in V.harmonize([a, b], [ColumnCluster("coo", ["coo_a", "coo_b"])], parents, master).collect()}
    assert got == {("1", "G1", "F", "x"), ("2", "G2", None, "y"), ("0", "G4", None, "old")}


def test_gene_reference(spark):
    genes = spark.createDataFrame([("ENSG1.18", "TSPAN6"), ("ENSG2.7", "TNMD")], "ID string, Gene string")
    tx = spark.createDataFrame([("ENST1.2", "ENSG1.18", "TSPAN6", 2206, True), ("ENST2.1", "ENSG1.18", "TSPAN6", 2100, True), ("ENST3.1", "ENSG1.18", "TSPAN6", 500, False)], "transcript_id string, gene_id string, gene_symbol string, transcript_length int, included boolean")
    ref = gene_reference(genes, tx)
    assert [tuple(r) for r in ref.lengths.collect()] == [("ENSG1", 2153)]
    assert {r.symbol for r in ref.known_symbols.collect()} == {"TSPAN6", "TNMD"} and ref.transcript_symbols.count() == 3


def test_parts_of_a_matrix(spark):
    cols = lambda n: [f"s{i}" for i in range(n + 1)]
    files = [("a", "x_counts.tsv", 0, 2000, cols(30)), ("a", "y.txt", 1, 10, cols(30)), ("b", "x.tsv", 0, 2000, cols(20)), ("b", "y.tsv", 1, 2000, cols(22)), ("c", "z.tsv", 0, 2000, ["chr", "start", "end"] + cols(29))]
    df = spark.createDataFrame(files, "cohort_id string, name string, ord int, n_rows int, columns array<string>")
    n = spark.createDataFrame([("a", 30), ("b", 41), ("c", 31)], "cohort_id string, n_samples int")
    assert {tuple(r) for r in primary_by_content(df, n).collect()} == {("a", "single", "x_counts.tsv"), ("b", "multi_part", "x.tsv;y.tsv"), ("c", "none", "")}


def test_median_polish(spark):
    cells = spark.createDataFrame([("c", f"p{i}", f"s{j}", 10.0 + i + 2 * j) for i in range(3) for j in range(4)] + [("c", "p9", "s0", None)], "cohort_id string, feature_id string, sample_id string, value double")
    sets = spark.createDataFrame([(f"p{i}", "S") for i in (0, 1, 2, 9)], "feature_id string, set_id string")
    got = {r.sample_id: r.value for r in median_polished(cells, sets).collect()}
    assert got == pytest.approx({f"s{j}": 11.0 + 2 * j for j in range(4)})
