import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortloom.functions import classify as C
from cohortloom.functions import clinical as K
from cohortloom.operators import graph as G
from cohortloom.operators import harmonize as H
from cohortloom.operators import identifiers as I
from cohortloom.operators import intake as T
from cohortloom.operators import matching as P
from cohortloom.operators import matrix as M
from cohortloom.operators import report as R
from cohortloom.operators import stats as S
from cohortloom.plans.providers import FilePlans, plan_key, rule_filters
from cohortloom.plans.schemas import ColumnCluster, ColumnMappingPlan, SurvivalMapping, cluster_plan, column_plan
from cohortloom.queries.cohorts import QUERIES

CELLS = "cohort_id string, feature_id string, sample_id string, value double"


def cells(spark, data):
    return spark.createDataFrame([("c", f, s, v) for f, s, v in data], CELLS)


def one(spark, column, *values):
    names = [f"v{i}" for i in range(len(values))]
    return spark.createDataFrame([values], ", ".join(f"{n} {'string' if isinstance(v, str) or v is None else 'long'}" for n, v in zip(names, values, strict=True))).select(column(*[F.col(n) for n in names]).alias("x")).first()["x"]


def test_probe_means(spark):
    m = cells(spark, [("1007", "G1", 6.566), ("1007", "G2", 7.001), ("1053", "G1", 3.208), ("117", "G1", 3.613), ("117", "G2", None), ("x", "G1", 1.0)])
    probes = spark.createDataFrame([("1007", "DDR1", "780"), ("117", "DDR1", "780"), ("1053", "RFC2", None), ("x", None, None)], "probe_id string, gene_symbol string, entrez_id string")
    got = {(r.gene_key, r.sample_id): r.value for r in M.probes_to_genes(m, probes).collect()}
    assert got == pytest.approx({("780", "G1"): (6.566 + 3.613) / 2, ("780", "G2"): 7.001, ("RFC2", "G1"): 3.208})


def test_scales(spark):
    m = cells(spark, [("a", "s", 0.0), ("b", "s", 99.0), ("c", "s", float("nan"))])
    got = {r.feature_id: r.value for r in M.log2_where_linear(m).collect()}
    assert got["a"] == 0 and got["b"] == pytest.approx(math.log2(100)) and got["c"] is None
    back = {r.feature_id: (r.value, r.was_log2) for r in M.linear_scale(cells(spark, [("a", "s", 3.0), ("b", "s", -1.0)])).collect()}
    assert back == {"a": (7.0, True), "b": (0.0, True)}
    assert sum(r.value for r in M.per_million(cells(spark, [("a", "s", 1.0), ("b", "s", 3.0)])).collect()) == pytest.approx(1e6)
    assert M.per_million(cells(spark, [("a", "s", 0.0)])).first()["value"] is None
    assert [r.sample_id for r in M.empty_samples(cells(spark, [("a", "s", 0.0), ("a", "t", 1.0)])).collect()] == ["s"]


def test_tpm_sums_to_a_million(spark):
    lengths = spark.createDataFrame([("a", 1000), ("b", 500), ("c", None)], "feature_id string, length long")
    got = M.tpm(cells(spark, [("a", "s", 10.0), ("b", "s", 20.0), ("c", "s", 5.0)]), lengths).collect()
    assert sum(r.value for r in got) == pytest.approx(1e6) and {r.feature_id for r in got} == {"a", "b"}


def test_orientation_and_negatives(spark):
    wide = cells(spark, [(f"f{i}", f"s{j}", float(i * j)) for i in range(12) for j in range(15)])
    assert {r.sample_id for r in M.normalized(wide).collect()} == {f"f{i}" for i in range(12)}
    assert "negative" in M.matrix_qc(cells(spark, [("a", "s", -1.0), ("b", "s", 60.0)])).first()["notes"]
    assert {r.value for r in M.normalized(cells(spark, [("a", "s", -1.0), ("b", "s", 60.0)])).collect()} == {-1.0, 60.0}


def test_coalescing_and_first_map(spark):
    a, b = cells(spark, [("1", "p", 1.0), ("2", "p", None)]), cells(spark, [("2", "p", 5.0), ("1", "p", 9.0), ("3", "p", 3.0)])
    assert {(r.feature_id, r.value) for r in M.combined_first(a, b, ["feature_id", "sample_id"]).collect()} == {("1", 1.0), ("2", 5.0), ("3", 3.0)}
    maps = [spark.createDataFrame([(1, "A")], "probe_id int, g string"), spark.createDataFrame([(1, "B"), (2, "C")], "probe_id int, g string")]
    assert {tuple(r) for r in M.first_map_wins(maps).collect()} == {(1, "A"), (2, "C")}


def test_reference_channel(spark):
    rng = random.Random(0)
    data = [("c", f"f{i}", f"s{j}", ch, 100.0 + j * 0.1 if ch == 1 else 50.0 * i * (1 + 5 * rng.random())) for i in range(1, 9) for j in range(6) for ch in (1, 2)]
    df = spark.createDataFrame(data, "cohort_id string, feature_id string, sample_id string, channel int, value double")
    hints = spark.createDataFrame([("c", 1), ("c", None)], "cohort_id string, hint int")
    assert M.reference_channel(df, hints).select("reference_channel", "signal_channel", "method").first() == (1, 2, "metadata+variance")
    assert M.reference_channel(df, hints.withColumn("hint", F.lit(2))).first()["method"] == "ambiguous"


def test_identifier_rules(spark):
    probes = spark.createDataFrame([("P1", "a", "DDR1 /// M", "780", None), ("P1", "b", None, None, "N // X // d // l // 9"), ("P2", "a", "---", " ", "N // --- /// N // FAM // d // 1q // 7 // 8x"), ("P2", "b", None, None, "--- /// ---")], "platform_id string, probe_id string, gene_symbol string, entrez_gene_id string, gene_assignment string")
    assert {tuple(r) for r in I.probe_gene_map(probes).collect()} == {("P1", "a", "DDR1", "780", "direct_columns"), ("P2", "a", "FAM", "7", "gene_assignment")}
    ids = spark.createDataFrame([("t", "ENST1.2|x"), ("t", "q"), ("g", "ENSG1.9"), ("s", "TP53"), ("s", "b"), ("u", "XLOC_1")], "cohort_id string, feature_id string")
    known = spark.createDataFrame([("TP53",)], "symbol string")
    assert {tuple(r) for r in I.identifier_type(ids, known).collect()} == {("t", "transcript"), ("g", "gene"), ("s", "symbol"), ("u", "unknown")}
    doubled = spark.createDataFrame([("a", "X_X"), ("a", "Y_3_Y"), ("a", "Z"), ("b", "X_X"), ("b", "Y"), ("b", "Z")], "cohort_id string, feature_id string")
    assert {tuple(r) for r in I.undoubled_ids(doubled).collect()} == {("a", "X"), ("a", "Y"), ("a", "Z"), ("b", "X_X"), ("b", "Y"), ("b", "Z")}


@pytest.mark.parametrize(("tech", "title", "kind"), [("high-throughput sequencing", "Single cell", "scrnaseq"), ("High throughput sequencing", None, "bulk_rnaseq"), ("in situ oligonucleotide", "x", "microarray"), (None, "x", "other")])
def test_assays(spark, tech, title, kind):
    assert one(spark, C.assay_type, tech, title) == kind


def test_platforms_and_files(spark):
    assert one(spark, C.array_content, "Human miRNA array") == "mirna" and one(spark, C.array_content, "Genome SNP 6") == "cna" and one(spark, C.array_content, None) == "mrna"
    assert [one(spark, C.coverage, n) for n in (None, "x", "0", "11999", "12000")] == ["unknown", "unknown", "unknown", "limited", "full_transcriptome"]
    assert one(spark, C.rnaseq_library, "unspecified", "ribo-zero kit") == "total_rna" and one(spark, C.rnaseq_library, "cDNA", "polyA") == "other"
    assert one(spark, C.skipped_url, "https://h/a.CEL.gz?x=1") and not one(spark, C.skipped_url, "ftp://h/a.txt.gz")
    assert not one(spark, C.matrix_candidate, "GSM12_counts.txt.gz") and one(spark, C.matrix_candidate, "a_TPM.csv.gz")


@pytest.mark.parametrize(("value", "code"), [("Complete response", "CR"), (" pr ", "PR"), ("SD", "SD"), ("disease progression", "PD"), ("n/a", "NE"), ("other", None), ("", None), (None, None)])
def test_recist(spark, value, code):
    assert one(spark, K.recist, value) == code


def test_events_and_times(spark):
    assert K.event_mapping("X=event, 'Y'=censored; z=?, q") == {"x": 1, "y": 0}
    assert K.event_mapping("0=no event, 1=event") == {"0": 1, "1": 1} and K.event_mapping("0=no event", strict=True) == {"0": 0}
    assert one(spark, lambda c: K.remap_event(c, "dead=event, alive=censored"), "status: DEAD") == "1"
    assert one(spark, lambda c: K.time_to_months(c, "years"), "Follow up years: 1.5") == 18.0
    assert one(spark, K.strip_label, "Chemotherapy: CHOP: x") == "CHOP: x"


def test_characteristics(spark):
    df = spark.createDataFrame([(1, [" Sex : F", "drug: a", "Drug: b: c", "no colon", None]), (2, []), (3, None)], "id int, l array<string>")
    got = {r.id: r.m for r in df.select("id", K.characteristics(F.col("l")).alias("m")).collect()}
    assert got == {1: {"sex": "F", "drug": "a", "drug_2": "b: c", "no colon": ""}, 2: {}, 3: {}}
    fp = spark.sql("select map('a', '1', 'b', null) x, map('b', '', 'a', '1') y").select(K.fingerprint(F.col("x")) == K.fingerprint(F.col("y"))).first()[0]
    assert fp


def test_matching_levels(spark):
    samples = spark.createDataFrame([("c", "GSM1", "DMSO 1"), ("c", "GSM2", "drug_A rep2"), ("c", "GSM3", "xx"), ("c", "GSM4", "same"), ("c", "GSM5", "same"), ("c", "GSM6", None)], "cohort_id string, gsm_id string, title string")
    cols = spark.createDataFrame([("c", x) for x in ("GSM1", "drug_A rep2", "dmso-1", "druga", "pre_XX_post", "same", "__")], "cohort_id string, expression_id string")
    got = {r.expression_id: (r.gsm_id, r.match_method) for r in P.matched_columns(cols, samples, ["title"]).collect()}
    assert got == {"GSM1": ("GSM1", "exact_gsm_id"), "drug_A rep2": ("GSM2", "exact"), "dmso-1": ("GSM1", "normalized_exact"), "druga": ("GSM2", "substring"), "pre_XX_post": ("GSM3", "reverse_substring"), "same": (None, "unmatched"), "__": (None, "unmatched")}


def test_positional_needs_equal_counts(spark):
    m = spark.createDataFrame([("c", "e1", 1, None, "unmatched", 0.0), ("c", "e2", 2, "S1", "exact", 0.95), ("d", "e3", 1, None, "unmatched", 0.0)], "cohort_id string, expression_id string, ord int, gsm_id string, match_method string, confidence double")
    s = spark.createDataFrame([("c", "S1", 1), ("c", "S2", 2), ("d", "S3", 1), ("d", "S4", 2)], "cohort_id string, gsm_id string, ord int")
    got = {r.expression_id: (r.gsm_id, r.match_method) for r in P.positional_matches(m, s).collect()}
    assert got == {"e1": ("S2", "positional_fallback"), "e2": ("S1", "exact"), "e3": (None, "unmatched")}


def test_pairs_are_one_to_one(spark):
    side = lambda data: spark.createDataFrame(data, "cohort_id string, sample_id string, pair_key string")
    a, b = [("c", "a1", "x"), ("c", "a2", "y"), ("d", "a3", "x")], [("c", "b2", "y"), ("c", "b1", "x"), ("d", "b3", "x"), ("d", "b4", "z")]
    assert {(r.left_id, r.right_id) for r in P.paired_samples(side(a), side(b)).collect()} == {("a1", "b1"), ("a2", "b2")}
    assert one(spark, lambda t: P.companion_title(t, "GPL96"), "PaCa1 HG-U133A _A") == "paca1"


def test_plans_and_clinical(spark, tmp_path):
    df = spark.createDataFrame([("1", "h", "a", "x", "Complete response", "2", "Dead"), ("2", "h", None, None, "PR", "t: 1.5", "Alive"), ("3", "h", None, "y", None, None, None)], "gsm_id string, organism string, drug string, dose string, `tumor response` string, os string, vital string")
    plan = ColumnMappingPlan(["organism"], ["drug", "absent"], ["dose"], "tumor response", [SurvivalMapping("OS", "os", "years", "vital", "Dead=event, Alive=censored"), SurvivalMapping("PFS", "nope", "days", "vital", "")])
    got = H.clinical_columns(df, plan)
    assert set(got.columns) == {"gsm_id", "treatment", "treatment_detail", "response", "recist", "OS_time", "OS_event"}
    assert {(r.gsm_id, r.treatment, r.recist, r.OS_time, r.OS_event) for r in got.collect()} == {("1", "a", "CR", 24.0, "1"), ("2", "", "PR", 18.0, "0"), ("3", "", None, None, None)}
    assert column_plan('{"treatment_columns": ["d"], "survival": [{"survival_type": "OS", "x": 1}], "y": 2}').survival == [SurvivalMapping("OS")]
    (tmp_path / "clusters.json").write_text('{"clusters": [{"canonical_name": "sex", "source_columns": ["g"]}]}')
    (tmp_path / "columns-G.json").write_text("{broken")
    plans = FilePlans(str(tmp_path))
    assert plans.clusters() == cluster_plan('{"clusters": [{"canonical_name": "sex", "source_columns": ["g"]}]}') and plans.column_plan("G") is None
    assert plan_key({"a": 1, "b": 2}) == plan_key({"b": 2, "a": 1})
    assert rule_filters("human AML RNA-seq with at least 20 samples").min_samples == 20


def test_harmonizing(spark):
    a = spark.createDataFrame([("1", "F"), ("2", None)], "id string, Gender string")
    b = spark.createDataFrame([("3", 1.5)], "id string, x double")
    assert {tuple(r) for r in H.union_all([H.aliased(a), b]).collect()} == {("1", "F", None), ("2", None, None), ("3", None, "1.5")}
    assert H.aliased(spark.createDataFrame([("F", "m")], "sex string, Sex string")).columns == ["sex", "Sex"]
    both = spark.createDataFrame([(None, "m")], "Gender string, SEX string")
    assert H.aliased(both).first()["sex"] == "m"
    coo = spark.createDataFrame([("1", "GCB", None), ("2", "germinal", None), ("3", None, "ABC")], "id string, a string, b string")
    assert {tuple(r) for r in H.clustered(coo, [ColumnCluster("coo", ["a", "b"], {"Germinal": "GCB"})]).collect()} == {("1", "GCB"), ("2", "GCB"), ("3", "ABC")}
    assert H.drop_constant(spark.createDataFrame([("1", "x", None), ("2", "x", "y")], "gsm_id string, k string, n string")).columns == ["gsm_id", "n"]
    props = spark.createDataFrame([("g", {"sex": "Female"}), ("g", {"tissue": "liver"}), ("h", {"tissue": "female liver"}), ("i", {"sex": "m"})], "gse_id string, characteristics map<string,string>")
    assert {tuple(r) for r in H.property_counts(props, [("sex", "female")]).collect()} == {("g", "sex:female=1/2"), ("h", "sex:female=1/1")}


def test_graph_with_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("b", "d")], "parent string, child string")
    roots = spark.createDataFrame([("a",), ("z",)], "id string")
    assert {(r.root, r.id, r.depth) for r in G.closure(roots, edges).collect()} == {("a", "a", 0), ("a", "b", 1), ("a", "c", 2), ("a", "d", 2), ("z", "z", 0)}
    assert {tuple(r) for r in G.leaves(roots, edges).collect()} == {("a", "d"), ("z", "z")}


def test_reports(spark):
    assert R.catalog_query(title="a", organism="b") == '("a"[Title] AND "b"[Organism]) AND GSE[ETYP]'
    with pytest.raises(ValueError):
        R.catalog_predicate()
    rep = R.report_rows(spark.createDataFrame([("G1", None, ["a", "b"])], "gse_id string, title string, platforms array<string>")).first()
    assert (rep.title, rep.platforms, rep.summary) == ("", "a;b", "") and rep.url.endswith("G1")
    hist = R.equal_width_histogram(spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "v double"), "v", 10)
    assert {(r.bin, r.n) for r in hist.collect()} == {(1, 2), (10, 1)}
    assert {(r.bin, r.n) for r in R.equal_width_histogram(spark.createDataFrame([(5.0,), (5.0,)], "v double"), "v").collect()} == {(1, 2)}


def test_bh_with_ties(spark):
    p = [0.01, 0.04, 0.03, 0.04, 0.2, 1.0, 1e-9, None]
    got = {r.i: r.q for r in S.benjamini_hochberg(spark.createDataFrame(list(enumerate(p)), "i int, p double"), "p", "q").collect()}
    known = sorted((v, i) for i, v in enumerate(p) if v is not None)
    want, least = {7: None}, 1.0
    for rank in range(len(known), 0, -1):
        v, i = known[rank - 1]
        least = min(least, v * len(known) / max(r for r, (w, _) in enumerate(known, 1) if w == v))
        want[i] = least
    assert got == pytest.approx(want)


def test_special_functions():
    assert S.digamma(1.0) == pytest.approx(-0.5772156649015329, abs=1e-12) and S.trigamma(1.0) == pytest.approx(math.pi**2 / 6, abs=1e-11)
    assert S.trigamma_inverse(S.trigamma(3.7)) == pytest.approx(3.7, rel=1e-6)
    assert S.t_two_sided(np.array([2.0, 0.0, math.inf]), np.array([1.0, 5.0, 3.0])) == pytest.approx([1 - 2 * math.atan(2) / math.pi, 1.0, 0.0])


def test_moderated_t_recovers_signal(spark):
    rng = np.random.default_rng(0)
    n, true = 300, 20
    x = rng.normal(8, 1, (n, 1)) + rng.normal(0, 0.3, (n, 12))
    x[:true, 6:] += rng.choice([-1, 1], (true, 1)) * rng.uniform(1.5, 3, (true, 1))
    data = spark.createDataFrame(pd.DataFrame([(f"g{i}", f"s{j}", float(x[i, j])) for i in range(n) for j in range(12)], columns=["feature_id", "sample_id", "value"]))
    samples = spark.createDataFrame([(f"s{j}", "a" if j < 6 else "b") for j in range(12)] + [("unmeasured", "b")], "sample_id string, group string")
    top = S.two_group(data, samples, "group").limit(true).collect()
    assert sum(int(r.feature_id[1:]) < true for r in top) >= 18 and [r.p_value for r in top] == sorted(r.p_value for r in top)
    with pytest.raises(ValueError, match="without annotation"):
        S.linear_fits(data, S.design_of(samples.where("sample_id not in ('s11', 'unmeasured')"), "group"))
    flat = data.withColumn("value", F.lit(1.0))
    assert all(math.isfinite(r.t) for r in S.two_group(flat, samples, "group").collect())


def test_missing_cells_have_their_own_error(spark):
    rng = np.random.default_rng(1)
    y = rng.normal(5, 1, (4, 10))
    gone = {(1, 0), (1, 1), (2, 9), (3, 5), (3, 6), (3, 7), (3, 8), (3, 9)}
    data = spark.createDataFrame([(f"g{i}", f"s{j}", None if (i, j) in gone else float(y[i, j])) for i in range(4) for j in range(10)], "feature_id string, sample_id string, value double")
    samples = spark.createDataFrame([(f"s{j}", "a" if j < 5 else "b") for j in range(10)], "sample_id string, group string")
    got = {r.feature_id: r for r in S.ordinary_t(S.linear_fits(data, S.design_of(samples, "group"))).collect()}
    for i in range(3):
        one, two = ([y[i, j] for j in places if (i, j) not in gone] for places in (range(5), range(5, 10)))
        s2 = (np.var(one) * len(one) + np.var(two) * len(two)) / (len(one) + len(two) - 2)
        r = got[f"g{i}"]
        assert (r.log_fc, r.s2, r.df) == pytest.approx((np.mean(two) - np.mean(one), s2, len(one) + len(two) - 2))
        assert r.t == pytest.approx((np.mean(two) - np.mean(one)) / math.sqrt(s2 * (1 / len(one) + 1 / len(two))))
    assert got["g3"].log_fc is None  # no sample of one group is left


def test_designs(spark):
    ann = spark.createDataFrame([("1", "a", "x", "a", "u", 1), ("2", "a", "y", "a", None, 2), ("3", "b", "x", "b", "u", 10), ("4", "b", "y", "b", "v", 2)], "sample_id string, g string, batch string, bad string, gap string, dose int")
    d = S.design_of(ann, "g", ["batch", "absent"])
    assert d.coefficient == "g[b]" and d.names == ["intercept", "g[b]", "batch_y"] and d.x.tolist()[1] == [1.0, 0.0, 1.0]
    with pytest.warns(UserWarning, match="bad"):
        assert S.design_of(ann, "g", ["bad"]).left_out == ["bad"]
    with pytest.warns(UserWarning, match="'u'"):
        assert S.design_of(ann, "g", ["gap"]).names == ["intercept", "g[b]", "gap_v"]
    assert S.design_of(ann, "g", ["dose"]).names == ["intercept", "g[b]", "dose_2", "dose_10"]
    assert S.design_of(ann, "g", reference="b").coefficient == "g[a]"
    for wrong in (ann.withColumn("g", F.col("sample_id")), ann.withColumn("g", F.when(F.col("g") == "a", "a"))):
        with pytest.raises(ValueError):
            S.design_of(wrong, "g")
    with pytest.raises(ValueError):
        S.design_of(ann, "g", reference="z")


def test_exact_medians(spark):
    draw = random.Random(5)
    groups = {"few": [3.0], "even": [1.0, 2.0, 4.0, 9.0], "same": [7.0] * 50, "many": [draw.gauss(0, 1) for _ in range(1001)], "crowd": [0.0] * 30 + [1e9] + [draw.random() for _ in range(30)]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("few", None), ("none", None)], "k string, v double")
    assert {r.k: r["median"] for r in M.exact_medians(df, ["k"], "v").collect()} == pytest.approx({k: float(np.median(v)) for k, v in groups.items()})


def test_event_meanings():
    assert K.event_mapping("1=death, 0=censored") == {"1": 1, "0": 0}
    assert K.event_mapping("'Dead' = event; \"Alive\"=still alive;x; =event, 2=unclear") == {"dead": 1, "alive": 0}
    assert K.event_mapping("0=no event") == {"0": 1} and K.event_mapping("0=no event", strict=True) == {"0": 0}
    assert K.event_mapping("") == {} and K.event_mapping(None) == {}


def test_clinical_apply_protects_and_notes(spark):
    df = spark.createDataFrame([("S1", "G", "P", "h", "Key: v 1", "Alive", "24.5", None), ("S2", "G", "P", "h", "Key: v 2", "Dead", "10.2", None)], "gsm_id string, gse_id string, platform_id string, organism string, info string, vital string, os string, empty string")
    out, notes = H.clinical_annotation(df, ColumnMappingPlan(["gse_id", "platform_id"], survival=[SurvivalMapping("OS", "os", "months", "vital", ""), SurvivalMapping("PFS", "os", "months", "vital", "1=event"), SurvivalMapping("X", "os", "days", None)], notes="by hand"))
    assert out.columns == ["gsm_id", "gse_id", "platform_id", "info", "OS_time", "OS_event"]  # organism is constant, empty too
    assert {(r.info, r.OS_time, r.OS_event) for r in out.collect()} == {("v 1", 24.5, "Alive"), ("v 2", 10.2, "Dead")}
    assert notes[0] == "by hand" and "OS_event" in notes[1] and len(notes) == 2
    assert H.clinical_columns(df.limit(0), ColumnMappingPlan()).columns == ["gsm_id", "gse_id", "platform_id"]


def test_findings_on_clusters(spark):
    df = spark.createDataFrame([("1", "GCB", None, "x"), ("2", "germinal", "ABC", "x"), ("3", None, "odd", "x"), ("4", None, None, None)], "id string, a string, b string, taken string")
    clusters = [ColumnCluster("coo", ["a", "b"], {"gcb": "GCB", "germinal ": "GCB"}), ColumnCluster("taken", ["a"])]
    assert {tuple(r) for r in H.cluster_notes(df, clusters[:1]).collect()} == {("coo", "several_values", "a, b", 1), ("coo", "unmapped", "odd", 1)}
    assert [tuple(r) for r in H.cluster_notes(df, clusters[1:]).collect()] == [("taken", "name_taken", "a", 0)]
    assert {r.value for r in H.open_mappings(df, clusters).collect()} == {"GCB", "germinal", "ABC", "odd"}
    assert H.open_mappings(df, [ColumnCluster("coo", ["a", "b"], dict.fromkeys(["GCB", "Germinal", "abc", "ODD"], "x"))]).collect() == []
    assert H.free_columns(["gsm_id", "llm_x", "OS_time", "recist", "grade"]) == ["grade"]


def test_merges_are_idempotent(spark):
    ann = spark.createDataFrame([("S1", "G", "old"), ("S2", "G", "old"), (None, "G", "old")], "gsm_id string, gse_id string, llm_a string")
    answers = spark.createDataFrame([("S1", "x", 1), ("S1", "y", 2)], "gsm_id string, llm_a string, other int")
    once = H.with_answers(ann, answers)
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in H.with_answers(once, answers).collect()} == {("S1", "G", "x"), ("S2", "G", None), (None, "G", None)}
    ids = spark.createDataFrame([("G", "S1", "e1", "exact", 0.95), ("G", "S1", "e0", "substring", 0.75), ("G", None, "e2", "unmatched", 0.0)], "gse_id string, gsm_id string, expression_id string, match_method string, confidence double")
    twice = H.with_id_map(H.with_id_map(ann, ids), ids)
    assert {(r.gsm_id, r.expression_id, r.id_match_confidence) for r in twice.collect()} == {("S1", "e1", 0.95), ("S2", None, None), (None, None, None)}


def _rows(spark, path, *lines):
    return spark.createDataFrame([(path, "", i, [None if c is None else str(c) for c in line], None) for i, line in enumerate(lines)], "path string, member string, row_ord long, cells array<string>, error string")


def test_intake_of_matrix_files(spark):
    keys = ["path", "member"]
    rows = _rows(spark, "a", ["seqnames", "strand", "gene_id", "Symbol", "HGNC", "#", "GSM1", "GSM2"], ["chr1", "+", "E1", "A1BG", "H:1", 1, 1.0, "NA"], ["chr17", "-", "E2", "TP53", "H:2", 2, 4.5, ""])
    rows = rows.unionByName(_rows(spark, "b", [f"U{i}" for i in range(30)], ["x"] * 30, [0] * 30)).unionByName(_rows(spark, "c", ["S1", "S2"], ["g1", 1, 2], ["g2", 3, 4])).unionByName(_rows(spark, "d", ["g", "S1"]))
    plan = T.intake_plan(rows, keys)
    got = {r.path: r for r in plan.collect()}
    assert (got["a"].id_column, [s.name for s in got["a"].samples], got["a"].dropped) == ("Symbol", ["GSM1", "GSM2"], ["seqnames", "strand", "gene_id", "HGNC", "#"])
    assert got["b"].status == "refused" and "left unchanged" in got["b"].notes and got["b"].dropped == []
    assert got["c"].id_column == "gene_id" and "no column name" in got["c"].notes and got["d"].n_rows == 0
    cells = {(r.path, r.feature_id, r.sample_id): r.value for r in T.intake_cells(rows, plan, keys).collect()}
    assert cells == {("a", "A1BG", "GSM1"): 1.0, ("a", "A1BG", "GSM2"): None, ("a", "TP53", "GSM1"): 4.5, ("a", "TP53", "GSM2"): None, ("c", "g1", "S1"): 1, ("c", "g1", "S2"): 2, ("c", "g2", "S1"): 3, ("c", "g2", "S2"): 4}
    assert T.intake_plan(rows.limit(0), keys).collect() == []


def test_axis_of_identifiers(spark):
    known = spark.createDataFrame([("TSPAN6",), ("TNMD",)], "symbol string")
    rows = _rows(spark, "a", ["Gene_name", "Gene_stable_ID", "S1"], ["TSPAN6", "ENSG00000000003.18", 1], ["TNMD", "ENSG00000000005", 2]).unionByName(_rows(spark, "b", ["x", "S1"], ["TSPAN6_TSPAN6", 1], ["TNMD_TNMD", 2])).unionByName(_rows(spark, "c", ["gene_id", "S1"], ["XLOC_1", 1], ["XLOC_2", 2]))
    assert {tuple(r) for r in T.identifier_axes(rows, known, ["path"]).collect()} == {("a", 2, "Gene_stable_ID", "gene"), ("b", 1, "x", "symbol")}


def test_primary_matrices(spark):
    body = [[f"g{i}", i % 40, i % 30] for i in range(1200)]
    rows = _rows(spark, "/d/A/x_counts.tsv", ["gene", "S1", "S2"], *body[:5]).unionByName(_rows(spark, "/d/A/x_FPKM.tsv", ["gene", "S1", "S2"], *[[g, a, 100] for g, a, _ in body[:5]]))
    parts = [_rows(spark, f"/d/B/part{k}.txt", ["gene", *[f"S{k}_{i}" for i in range(20)]], *[[f"g{i}"] + [i % 9] * 20 for i in range(1000)]) for k in range(2)]
    rows = rows.unionByName(parts[0]).unionByName(parts[1]).unionByName(_rows(spark, "/d/C/y_diff.tsv", ["gene", "S1"], ["g", 1]))
    samples = spark.createDataFrame([("A", 2), ("B", 40), ("C", 1)], "cohort_id string, n_samples int")
    report, final = T.primary_matrices(rows, samples)
    got = {r.cohort_id: r for r in report.collect()}
    assert (got["A"].path, got["A"].unit, got["A"].status, got["A"].truncated) == ("/d/A/x_FPKM.tsv", "fpkm", "ok", True) and "only 5 genes" in got["A"].notes
    assert got["B"].status == "multi_part" and "part0.txt;part1.txt" in got["B"].notes and got["C"].status == "none"
    assert {r.cohort_id for r in final.collect()} == {"A"} and max(r.value for r in final.collect()) == pytest.approx(math.log2(101))
    names = spark.createDataFrame([("a.csv",), ("b.TSV.gz",), ("c.xlsx",), ("d",)], "n string").select(T.output_name(F.col("n")), T.needs_conversion(F.col("n"))).collect()
    assert [tuple(r) for r in names] == [("a.tsv.gz", True), ("b.tsv.gz", False), ("c.tsv.gz", True), ("d.tsv.gz", False)]


def test_containing_by_rare_pieces(spark):
    draw = random.Random(2)
    word = lambda: "".join(draw.choice("ab1") for _ in range(draw.randint(0, 9)))
    parts, wholes = {("c", word()) for _ in range(80)}, {("c", word() + word()) for _ in range(60)} | {("d", "abab")}
    got = P.contained(spark.createDataFrame(sorted(parts), "cohort_id string, part string"), spark.createDataFrame(sorted(wholes), "cohort_id string, whole string"))
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == {(c, p, w) for c, p in parts for k, w in wholes if c == k and p and p in w}


def test_positional_match_has_all_cohorts(spark, rows, tmp_path):
    # Cohorts G0 to G9 of one open column and one sample each; G2 has a second sample, so that its counts differ.
    ids = [(i, f"G{i}", f"col{i}", f"GSM{i}") for i in range(10)]
    spark.createDataFrame(ids, "row_id long, gse_id string, expression_id string, gsm_id string").write.parquet(str(tmp_path / "sample_id_map.parquet"))
    samples = [(i, f"G{i}", f"GSM{i}", "tumour", "liver") for i in range(10)] + [(10, "G2", "GSM10", "normal", "liver")]
    spark.createDataFrame(samples, "row_id long, gse_id string, gsm_id string, title string, tissue string").write.parquet(str(tmp_path / "annotation.parquet"))
    want = [(f"G{i}", f"col{i}", f"GSM{i}", "positional_fallback", 0.5) if i != 2 else ("G2", "col2", None, "unmatched", 0.0) for i in range(10)]
    assert rows(QUERIES["positional_match"](spark, str(tmp_path)), "cohort_id", "expression_id", "gsm_id", "match_method", "confidence") == sorted(want, key=repr)


def test_graph_queries_start_from_all_series(spark, rows, tmp_path):
    ids = range(1, 131)
    spark.createDataFrame([(i,) for i in ids], "row_id long").write.parquet(str(tmp_path / "series.parquet"))
    children = {}
    for i in ids:
        if i % 7 and i >= 3:
            children.setdefault(i // 3, []).append(i)
    children.setdefault(40, []).append(1)
    reached = set()
    for root in ids:
        depth, level = {root: 0}, [root]
        while level:
            level = [c for p in level for c in children.get(p, ()) if depth.setdefault(c, depth[p] + 1) == depth[p] + 1 and c != p]
        reached |= {(root, i, n) for i, n in depth.items()}
    assert rows(QUERIES["graph_closure"](spark, str(tmp_path)), "root", "id", "depth") == sorted(reached, key=repr)
    assert rows(QUERIES["graph_leaves"](spark, str(tmp_path)), "root", "id") == sorted(((r, i) for r, i, _ in reached if i not in children), key=repr)
