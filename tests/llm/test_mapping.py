import pytest

from cohortloom.llm.mapping import Reference, _edits, allowed_edits, map_values, reference_lists

DIAGNOSES = [(1, "renal small-cell carcinoma", ["RESMCE-CAR"]), (2, "renal lymphoma", []), (3, "gastric lymphoma", ["GA-LYM"]), (4, "gastric squamous carcinoma", []), (5, "hepatic lymphoma", []), (6, "hepatic squamous carcinoma", []), (7, "hepatic small-cell carcinoma", []), (8, "renal squamous carcinoma", []), (9, "colonic lymphoma", []), (10, "colonic squamous carcinoma", []), (11, "colonic small-cell carcinoma", []), (12, "refractory anemia", [])]
TISSUES = [(20, "lymph node", []), (21, "bone marrow aspirate", []), (22, "lung lobe", ["LLX"]), (23, "placenta", []), (24, "skeletal muscle", [])]
DRUGS = [(30, "velotinib", ["VEI-418", "Velmabra"]), (31, "cisprolatin", [])]


@pytest.fixture(scope="module")
def reference():
    return {"diagnosis": Reference(DIAGNOSES), "tissue": Reference(TISSUES), "treatment": Reference(DRUGS)}


@pytest.mark.parametrize(
    ("concept", "text", "ref"),
    [
        ("diagnosis", "renal small-cell carcinoma", 1), ("diagnosis", "RENAL SMALL-CELL CA.", 1), ("diagnosis", "rena lsmall-cell carcinoma", 1), ("diagnosis", "carcinoma, renal small-cell", 1),
        ("diagnosis", "Dx: carcinoma of renal small-cell type", 1), ("diagnosis", "renal small-сеll сarcinomas", 1), ("diagnosis", "resmce-car", 1), ("diagnosis", "RESMCE/CAR", 1), ("diagnosis", "RESMCE-CAT", 0),
        ("diagnosis", "pat. with gastric lymph., stage IIIB", 3), ("diagnosis", '"gastric sq. carc."', 4), ("diagnosis", "hepatic_squamous_carcinoma; see report", 6), ("diagnosis", "refractory anaemia", 12),
        ("diagnosis", "gastric small-cell carcinoma", 0), ("diagnosis", "gastric smal-cell carcinoma", 0), ("diagnosis", "saliva swab", 0), ("diagnosis", "2020-01-01", 0), ("diagnosis", "??", 0),
        ("tissue", "node (lymph)", 20), ("tissue", "tissue: bone marow asp. #2", 21), ("tissue", "llx", 22), ("tissue", "placebo", 0), ("tissue", "muscle, skleetal", 24), ("tissue", "human lung lobe, FFPE", 22),
        ("treatment", "single-agent velotinib", 30), ("treatment", "VEI 418", 30), ("treatment", "VEI-419", 0), ("treatment", "velmabra 100 mg", 30), ("treatment", "cisprolatin, cycle 2", 31), ("treatment", "untreated", 0),
    ],
)
def test_values(reference, concept, text, ref):
    assert reference[concept].match(text) == ref


def test_automaton_equals_brute_force(reference):
    r = reference["diagnosis"]
    for text in ("renalymphoma", "gastrcilymphoma", "hepaticsquamouscarcinoma", "xyz", ""):
        for k in range(4):
            assert r.within(text, k) == {f: _edits(f, text) for f in r.forms if _edits(f, text) <= k}


def test_long_values(reference):
    """A value of any length is searched; the work grows with its words and not their square."""
    r = reference["diagnosis"]
    remark = "; see report of the primary sample, stage IIIB, grade 2, biopsy proven, dose 100 mg daily"
    assert r.match("renal small-cell carcinoma" + remark) == r.match("renal small-cell carcinoma" + remark * 3) == 1
    assert r.match("Dx: " + "confirmed " * 3000 + "gastric sq. carc. " + "stage IIIB " * 3000) == 4
    assert r.match("renal lymphoma and hepatic lymphoma " * 500) == 0 and r.match("y" * 200_000) == 0


def test_distances():
    assert [_edits(*p) for p in (("ab", "ba"), ("abc", "ac"), ("", "abc"), ("kitten", "sitting"))] == [1, 1, 3, 3]
    assert [allowed_edits(n) for n in (3, 5, 8, 12, 30)] == [0, 1, 2, 3, 4]


def test_frame(spark):
    ref = spark.createDataFrame([(i, "diagnosis", n, a, "x") for i, n, a in DIAGNOSES] + [(40, "diagnosis", None, None, "x")], "ref_id long, concept string, canonical_value string, aliases array<string>, value string")
    rows = [("t", 1, "diagnosis", "renal lymphoma"), ("t", 1, "diagnosis", "renal lymphoma"), ("t", 2, "diagnosis", None), ("t", 3, "diagnosis", "---"), ("t", 4, "none", "renal lymphoma"), ("u", 5, "diagnosis", "x" * 5000), ("u", 6, None, "renal lymphoma")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "src_table string, row_id long, concept string, value string, ref_id string")
    got = sorted(tuple(r) for r in map_values(df, ref).collect())
    assert got == [("t", 1, 2), ("t", 1, 2), ("t", 4, 0), ("u", 5, 0), ("u", 6, 0)]
    assert map_values(df.limit(0), ref).collect() == [] and {r.ref_id for r in map_values(df, ref.limit(0)).collect()} == {0}
    with pytest.raises(ValueError):
        reference_lists(ref, limit=3)
