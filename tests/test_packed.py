import pytest
from pyspark.sql import functions as F

from cohortloom.operators.packed import SEPARATORS, cut_cell, split_packed, with_skeleton

SCHEMA = "row_id long, gene_symbol string, entrez_gene_id string, gene_assignment string, cell string, rule string"

CASES = [
    ("A1", [(1, "A1")]),
    (" A1  ", [(1, "A1")]),
    ("A1,B2", [(1, "A1"), (2, "B2")]),
    ("A1; B2; ; C3", [(1, "A1"), (2, "B2"), (4, "C3")]),
    ("A1 /// ---///B2", [(1, "A1"), (3, "B2")]),
    ("A1//////B2", [(1, "A1"), (3, "B2")]),
    ("A1 // B2 /// C3", [(1, "A1"), (2, "B2"), (3, "C3")]),
    ("A1 / B2 /  / C3 / ", [(1, "A1"), (2, "B2"), (4, "C3")]),
    ("A1/B2", [(1, "A1/B2")]),
    ('"A1/B2",C3', [(1, "A1/B2"), (2, "C3")]),
    ('"A1, long form"; \'B2;iso1\'', [(1, "A1, long form"), (2, "B2;iso1")]),
    ('"A1 ""short"""|B2', [(1, 'A1 "short"'), (2, "B2")]),
    ("\n,80585", [(3, "80585")]),
    ("A1\n\nB2", [(1, "A1"), (3, "B2")]),
    ("A1\tB2\t", [(1, "A1"), (2, "B2")]),
    ("'A1',2,'B3' /// 'C4'", [(1, "A1"), (2, "2"), (3, "B3"), (4, "C4")]),
    ('A1 "x', [(1, 'A1 "x')]),
    ("none,---, ,NONE", []),
    ("kinase, alpha chain; box 2", [(1, "kinase, alpha chain"), (2, "box 2")]),
    ("kinase, alpha chain", [(1, "kinase"), (2, "alpha chain")]),
    ("A1, B2; C3", [(1, "A1"), (2, "B2"), (3, "C3")]),
    ('abc "x;y" def', [(1, 'abc "x;y" def')]),
    ("p" * 5000 + ' "x;y" def', [(1, "p" * 5000 + ' "x;y" def')]),
    ("ribose factor A1/B2 like /// A1 | B2", [(1, "ribose factor A1/B2 like"), (2, "A1 | B2")]),
]


@pytest.fixture(scope="module")
def split(spark):
    data = [(i, c, None, None, "clash", "clash") for i, (c, _) in enumerate(CASES)]
    data += [
        (100, None, "", "---", "", ""),
        (101, None, None, 'N_1 // G1 // "box, 3 /// pseudo // x" // 7q // 9 ///\nN_2 // ---\n--- /// N_3//G3', "", ""),
        (102, None, None, "N_1 | G1 | kinase (Glu-Ala/His) 3; member 2 | 7q | --- /// N_2 | G2", "", ""),
        (104, None, None, "N_1 // G1 // box a|b, 3 // 7q // 9 /// N_2 | G2 | old // new | 8p | ---", "", ""),
        (105, None, None, "N_1 // G1 // box 3 // of two // parts // 7q // 9", "", ""),
        (106, None, None, "N_1 // G1 // kinase\nalpha // 7q // 9\nN_2 // G2\n---\nN_4 // G4", "", ""),
        (103, ",".join(f"S{i}" for i in range(5000)), None, None, "", ""),
        (100, "A,B", None, None, "", ""),
    ]
    out = split_packed(spark.createDataFrame(data, SCHEMA), ["gene_symbol", "entrez_gene_id", "gene_assignment"], nested=("gene_assignment",))
    return [tuple(r) for r in out.collect()]


@pytest.mark.parametrize("i", range(len(CASES)))
def test_cells(split, i):
    assert sorted((s, item) for r, f, s, p, item in split if r == i) == CASES[i][1]


def test_records_and_pieces(split):
    of = lambda i: sorted((s, p, item) for r, f, s, p, item in split if r == i and f == "gene_assignment")
    assert of(101) == [(1, 1, "N_1"), (1, 2, "G1"), (1, 3, "box, 3 /// pseudo // x"), (1, 4, "7q"), (1, 5, "9"), (2, 1, "N_2"), (4, 1, "N_3"), (4, 2, "G3")]
    assert of(102) == [(1, 1, "N_1"), (1, 2, "G1"), (1, 3, "kinase (Glu-Ala/His) 3; member 2"), (1, 4, "7q"), (2, 1, "N_2"), (2, 2, "G2")]


def test_rules_tell_separators_from_values(split):
    of = lambda i: sorted((s, p, item) for r, f, s, p, item in split if r == i)
    assert of(104) == [(1, 1, "N_1"), (1, 2, "G1"), (1, 3, "box a|b, 3"), (1, 4, "7q"), (1, 5, "9"), (2, 1, "N_2"), (2, 2, "G2"), (2, 3, "old // new"), (2, 4, "8p")]
    assert of(105) == [(1, 1, "N_1"), (1, 2, "G1"), (1, 3, "box 3 // of two // parts"), (1, 4, "7q"), (1, 5, "9")]
    assert of(106) == [(1, 1, "N_1"), (1, 2, "G1"), (1, 3, "kinase\nalpha"), (1, 4, "7q"), (1, 5, "9"), (2, 1, "N_2"), (2, 2, "G2"), (4, 1, "N_4"), (4, 2, "G4")]


def test_without_rules_the_same_cells_are_cut_wrong(split):
    everything = "|".join(SEPARATORS)
    assert [p["item"] for p in cut_cell("kinase, alpha chain; box 2", everything, False, {})] == ["kinase", "alpha chain", "box 2"]
    assert len(cut_cell("N_1 // G1 // box a|b, 3 // 7q // 9", "triple:double|bar:0", True, {})) == 5  # a record keeps its own separator
    assert len(cut_cell("N_1 // G1 // box 3 // of two // parts // 7q // 9", "triple:double:0", True, {})) == 7


def test_skeletons_are_few(spark):
    cells = spark.range(1000).selectExpr("concat_ws(',', transform(sequence(0, id % 50), i -> concat('G', i + id))) as cell")
    assert with_skeleton(cells.withColumn("nested", F.lit(False))).select("skeleton").distinct().count() == 2


def test_long_cells_and_repeated_rows(split):
    assert sum(r == 103 for r, *_ in split) == 5000
    assert sorted(item for r, *_, item in split if r == 100) == ["A", "B"]


def test_empty_table(spark):
    assert split_packed(spark.createDataFrame([], SCHEMA), ["gene_symbol"]).collect() == []


def test_rules_of_one_shape_cut_alike():
    assert [p["item"] for p in cut_cell("a;b", "semi", False, {})] == ["a", "b"]
    assert [p["item"] for p in cut_cell("a;b", "none", False, {})] == ["a;b"]
