"""Queries of the annotation, harmonization, matching, report and statistics operators over the cohort tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions import classify as C
from cohortloom.functions import clinical as K
from cohortloom.functions.keys import normal_key
from cohortloom.operators import graph as G
from cohortloom.operators import harmonize as H
from cohortloom.operators import matching as P
from cohortloom.operators import primary_file as F_primary
from cohortloom.operators import report as R
from cohortloom.operators import stats as S
from cohortloom.plans.schemas import ColumnCluster, ColumnMappingPlan, SurvivalMapping
from cohortloom.session import cut_lineage, load


# --- classes of platforms and files --------------------------------------------------------------------------------
def classify_assay(spark, d):
    p = load(spark, d, "platform")
    return p.select("platform_id", C.assay_type(F.col("technology"), F.col("title")).alias("assay_type"))


def classify_vendor(spark, d):
    return load(spark, d, "platform").select("platform_id", C.vendor(F.col("manufacturer"), F.concat("title", F.when(F.col("data_row_count") > 40000, " for Illumina").otherwise(" agilent"))).alias("vendor"))


def array_content(spark, d):
    title = F.concat("title", F.element_at(F.array(*[F.lit(x) for x in (" human miRNA", " SNP 6.0", " lncRNA and mRNA", " long non-coding", "")]), (F.col("data_row_count") % 5 + 1).cast("int")))
    return load(spark, d, "platform").select("platform_id", C.array_content(title).alias("array_content"))


def coverage_bucket(spark, d):
    return load(spark, d, "platform").select("platform_id", C.coverage(F.col("data_row_count")).alias("coverage"))


def platform_gate(spark, d):
    return load(spark, d, "platform").select("platform_id", C.platform_verdict(F.col("technology"), F.col("title"), (F.col("data_row_count") / 3).cast("int")).alias("v")).select("platform_id", "v.*")


def _urls(spark, d):
    return load(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"((?:https?|ftp)://[A-Za-z0-9./?=&_-]*[A-Za-z0-9/])"))).alias("url"))


def url_extension_filter(spark, d):
    u = _urls(spark, d).withColumn("url", F.when(F.length("url") % 3 == 0, F.concat(F.col("url"), F.lit("/a.fastq.gz"))).when(F.length("url") % 3 == 1, F.concat(F.col("url"), F.lit("/b.CEL"))).otherwise(F.col("url")))
    return u.where(~C.skipped_url(F.col("url"))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_kept"))


def _names(spark, d):
    return load(spark, d, "series").select("row_id", F.concat("gse_id", F.element_at(F.array(*[F.lit(x) for x in ("_TPM.txt.gz", "_counts.csv", "_FPKM_diff.tsv", "_GSM12_raw.txt", "_matrix.pdf", "_rpkm.xlsx", "_data.tsv")]), (F.col("row_id") % 7 + 1).cast("int"))).alias("name"))


def matrix_candidates(spark, d):
    unit = C.quantity_unit(F.col("name"))
    return _names(spark, d).select("row_id", C.data_file(F.col("name")).alias("is_data"), C.matrix_candidate(F.col("name")).alias("is_candidate"), unit["rank"].alias("unit_rank"), unit["unit"].alias("unit"))


def ranked_first(spark, d):
    names = _names(spark, d).join(load(spark, d, "series").select("row_id", F.col("organism"), "n_samples"), "row_id").where(C.matrix_candidate(F.col("name")))
    return R.ranked_first(names.select("organism", "name", "row_id"), ["organism"], [C.quantity_unit(F.col("name"))["rank"], F.col("row_id")]).select("organism", "name", "row_id")


def _tables(spark, d):
    """Two to three tables a series, with columns about its samples."""
    s = load(spark, d, "series").where("n_samples is not null").select(F.col("row_id").alias("cohort_id"), (F.col("n_samples") % 40 + 6).alias("n_samples"))
    names = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(n).alias("name")) for i, n in enumerate(("a_counts.tsv.gz", "b_FPKM.csv", "c.txt", "GSM7_tpm.txt"))])
    t = s.select("cohort_id", "n_samples", F.explode(names).alias("f")).select("cohort_id", "n_samples", "f.*").where("ord < 2 + cohort_id % 3")
    columns = F.transform(F.sequence(F.lit(0), F.floor(F.col("n_samples") * (F.col("ord") + F.col("cohort_id") % 2 + 1) / 3).cast("int")), lambda i: F.concat(F.when(F.col("cohort_id") % 9 == 0, F.element_at(F.array(F.lit("Chr"), F.lit("START"), F.lit("end")), (i % 3 + 1).cast("int"))).otherwise("s"), F.when(F.col("cohort_id") % 9 == 0, "").otherwise(i.cast("string"))))
    return s, t.select("cohort_id", "name", "ord", (F.col("cohort_id") % 5 * 600).alias("n_rows"), columns.alias("columns"))


def primary_by_name(spark, d):
    return F_primary.primary_by_name(_tables(spark, d)[1])


def primary_by_content(spark, d):
    samples, files = _tables(spark, d)
    return F_primary.primary_by_content(files, samples)


def sample_count_fit(spark, d):
    return load(spark, d, "series").select("row_id", C.sample_count_fits(F.col("n_samples") + F.col("row_id").cast("int") % 60 - 30, F.col("n_samples")).alias("fits"))


def rnaseq_library(spark, d):
    return load(spark, d, "sample_group").select("row_id", C.rnaseq_library(F.when(F.col("row_id") % 4 == 0, "PolyA").when(F.col("row_id") % 4 == 1, "unspecified").when(F.col("row_id") % 4 == 2, "RANDOM PCR"), F.concat(F.lit("total RNA from "), F.col("tissue_detail"))).alias("library"))


def ordered_exclusion_reason(spark, d):
    p = load(spark, d, "part")
    return p.select(
        "p_partkey",
        C.exclusion_reason(F.when(F.col("p_size") == 1, "chrM").otherwise("chr1"), F.when(F.col("p_size") == 2, "H2AC4").when(F.col("p_size") == 3, "IGHV1-2").otherwise(F.col("p_brand")), F.when(F.col("p_size") == 4, "lncRNA").otherwise("protein_coding"), F.when(F.col("p_size") == 5, "x,readthrough_gene"), F.when(F.col("p_size") == 6, "retained_intron").otherwise("protein_coding"), F.col("p_size") * 30, F.when(F.col("p_size") % 11 > 0, "CCDS1"), F.when(F.col("p_size") == 23, "partial").otherwise("full_contig"), F.when(F.col("p_size") == 24, "2").otherwise("1")).alias("reason"),
    )


# --- clinical values -----------------------------------------------------------------------------------------------
MEANING = "dead=event, deceased=event, alive=censored, 1=death, 0=censored"


def recist(spark, d):
    return load(spark, d, "annotation").select("row_id", K.recist(F.col("tumor_response")).alias("recist"))


def event_remap(spark, d):
    return load(spark, d, "annotation").select("row_id", K.remap_event(F.col("vital_status"), MEANING).alias("event"))


def time_to_months(spark, d):
    return load(spark, d, "followup").select("row_id", F.round(K.time_to_months(F.col("raw_time"), "days"), 6).alias("months"))


def strip_label(spark, d):
    return load(spark, d, "annotation").select("row_id", K.strip_label(F.col("vital_status")).alias("vital_status"))


def species(spark, d):
    return load(spark, d, "series").groupBy(K.species_class(F.col("organism")).alias("species")).agg(F.count(F.lit(1)).alias("n"))


def expression_status(spark, d):
    a = load(spark, d, "annotation")
    return a.select("row_id", K.expression_status(F.col("expression_status") != "no_expression_matrix", F.coalesce(F.col("age") < 85, F.lit(True)), F.col("sex") == "unknown", F.col("os_months"), F.when(F.col("tumor_response") == "PD", 2).otherwise(0), F.coalesce(F.col("age") > 80, F.lit(False)), F.col("expression_status") == "low_gene_count").alias("status"))


PLAN = ColumnMappingPlan(["organism"], ["drug", "tissue"], ["dose_schedule"], "tumor_response", [SurvivalMapping("OS", "os_months", "months", "vital_status", MEANING)])


def clinical_unify(spark, d):
    a = load(spark, d, "annotation").select("row_id", "organism", "drug", "tissue", "dose_schedule", "tumor_response", "os_months", "vital_status")
    return H.clinical_columns(a, PLAN).withColumn("OS_time", F.round("OS_time", 6))


NOISY_PLAN = ColumnMappingPlan(["organism", "gse_id", "platform_id"], ["drug"], ["dose_schedule"], "tumor_response", [SurvivalMapping("OS", "os_months", "days", "vital_status", "unclear"), SurvivalMapping("PFS", "os_months", "months", "vital_status", MEANING)])


def clinical_protected(spark, d):
    """A plan that calls id columns redundant, and a constant column that it doesn't name."""
    a = load(spark, d, "annotation").select("row_id", "gsm_id", "gse_id", "platform_id", "organism", "sex", "drug", "dose_schedule", "tumor_response", "os_months", "vital_status", F.lit("x").alias("batch"))
    out, notes = H.clinical_annotation(a, NOISY_PLAN)
    return out.withColumn("OS_time", F.round("OS_time", 6)).withColumn("notes", F.lit("; ".join(notes)))


def _lines(spark, d):
    a = load(spark, d, "annotation")
    line = lambda k, c: F.concat(F.lit(k), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return a.select("row_id", "gse_id", F.array(line(" Sex : ", "sex"), line("drug: ", "drug"), line("Drug: ", "dose_schedule"), F.coalesce("tissue", F.lit("no tissue"))).alias("lines"))


def characteristics_map(spark, d):
    m = _lines(spark, d).select("row_id", K.characteristics(F.col("lines")).alias("m"))
    return m.select("row_id", F.explode("m").alias("key", "value"))


def json_props(spark, d):
    e = load(spark, d, "events")
    return e.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


def platform_details(spark, d):
    details = F.coalesce(F.from_json("platform_details", "array<struct<platform_id:string,assay_type:string>>"), F.array())
    s = load(spark, d, "series").select("row_id", details.alias("p"))
    return s.select("row_id", F.array_join(F.array_sort(F.array_distinct(F.transform("p", lambda x: x["assay_type"]))), ";").alias("assay_type"), F.array_join(F.array_sort(F.array_distinct(F.transform("p", lambda x: x["platform_id"]))), ";").alias("platforms"))


def fingerprint_groups(spark, d):
    e = load(spark, d, "annotation").withColumn("fingerprint_id", K.fingerprint(F.create_map(F.lit("sex"), F.col("sex"), F.lit("response"), F.col("tumor_response"), F.lit("status"), F.col("expression_status"))))
    return H.fingerprint_groups(e, "platform_id", "gsm_id").drop("fingerprint_id")


def fingerprint_join(spark, d):
    groups = load(spark, d, "sample_group").groupBy("gse_id").agg(F.max("tissue_class").alias("tissue_class"), F.max("prior_therapy_detail").alias("prior_therapy_detail"))
    a = load(spark, d, "annotation").select("row_id", "gse_id")
    return H.group_answers(a, groups, ["tissue_class"], ["prior_therapy_detail"], "gse_id")


def vocab_normalize(spark, d):
    v = load(spark, d, "value_mapping_entry").select("row_id", "raw_value")
    return H.vocabulary(v, "raw_value", load(spark, d, "canonical_value").select(F.col("canonical_value").alias("term")))


def column_profile(spark, d):
    a = load(spark, d, "annotation").withColumn("constant", F.lit("x"))
    return H.column_profile(a, ["sex", "tissue", "organism", "age", "drug", "os_months", "constant"]).withColumn("numeric_share", F.round("numeric_share", 6))


def column_summary_topk(spark, d):
    return H.column_summary(load(spark, d, "annotation"), "platform_id", ["sex", "tissue", "expression_status"], 5)


def distinct_listagg(spark, d):
    return load(spark, d, "sample_group").where("tissue_class <> 'unknown'").groupBy("gse_id").agg(F.array_join(F.array_sort(F.collect_set("tissue_class")), ", ").alias("tissues"))


CLUSTERS = [ColumnCluster("sex", ["sex_a", "sex_b"], {"f": "female", "m": "male"}), ColumnCluster("response", ["tumor_response", "absent"])]


def cluster_coalesce(spark, d):
    a = load(spark, d, "annotation").select("row_id", F.when(F.col("row_id") % 2 == 0, F.col("sex")).alias("sex_a"), F.col("sex").alias("sex_b"), "tumor_response")
    return H.clustered(a, CLUSTERS)


def cluster_notes(spark, d):
    a = load(spark, d, "annotation").select("row_id", F.when(F.col("row_id") % 2 == 0, F.col("sex")).alias("sex_a"), F.col("sex").alias("sex_b"), "tumor_response", F.col("tissue").alias("response"))
    return H.cluster_notes(a, CLUSTERS)


def open_mappings(spark, d):
    a = load(spark, d, "annotation").select(F.when(F.col("row_id") % 2 == 0, F.col("sex")).alias("sex_a"), F.col("vital_status").alias("sex_b"), "tumor_response")
    return H.open_mappings(a, CLUSTERS)


def answers_merged(spark, d):
    g = load(spark, d, "sample_group").select("gse_id", F.col("diagnosis").alias("llm_diagnosis"), F.col("prior_therapy").alias("llm_prior_therapy"), "tissue_class")
    a = load(spark, d, "annotation").select("row_id", "gse_id", F.lit("old").alias("llm_diagnosis"))
    return H.with_answers(H.with_answers(a, g, "gse_id"), g, "gse_id")


def id_map_merged(spark, d):
    a = load(spark, d, "annotation").select("row_id", "gse_id", "gsm_id", F.lit("old").alias("expression_id"))
    m = load(spark, d, "sample_id_map").select("gse_id", "gsm_id", "expression_id", "match_method", "confidence")
    return H.with_id_map(H.with_id_map(a, m), m)


def union_schema_evolution(spark, d):
    a = load(spark, d, "annotation").select("gsm_id", "gse_id", F.col("sex").alias("Gender"), "age")
    g = load(spark, d, "sample_group").select("gse_id", "diagnosis", "tissue_class")
    return H.union_all([H.aliased(a), H.aliased(g)]).withColumn("age", F.col("age").try_cast("double"))


def drop_parents(spark, d):
    return H.without_parents(load(spark, d, "annotation").select("row_id", "gse_id"), load(spark, d, "series").where("removed_at is not null").select("gse_id"))


def sample_property_filter(spark, d):
    rows = _lines(spark, d).select("gse_id", K.characteristics(F.col("lines")).alias("characteristics"))
    return H.property_counts(rows, [("sex", "female"), ("cell line", "velotinib")])


# --- matching ------------------------------------------------------------------------------------------------------
def _columns(spark, d):
    # A cohort's expression columns with the labels of its samples; one delivery of each.
    m = load(spark, d, "sample_id_map")
    return m.where("gse_id is not null").groupBy(F.col("gse_id").alias("cohort_id"), "expression_id").agg(F.min("row_id").alias("ord"))


def _samples(spark, d):
    a = load(spark, d, "annotation").where("gse_id is not null and gsm_id is not null")
    return a.groupBy(F.col("gse_id").alias("cohort_id"), "gsm_id").agg(F.min("title").alias("title"), F.min("tissue").alias("tissue"), F.min("row_id").alias("ord"))


def sample_id_match(spark, d):
    return P.matched_columns(cut_lineage(_columns(spark, d)), cut_lineage(_samples(spark, d)), ["title", "tissue"]).drop("ord")


def positional_match(spark, d):
    cols, samples = cut_lineage(_columns(spark, d)), cut_lineage(_samples(spark, d))
    return P.positional_matches(cut_lineage(P.matched_columns(cols, samples, ["title"])), samples).drop("ord")


def match_status(spark, d):
    ids = load(spark, d, "sample_id_map").select(F.col("gse_id").alias("cohort_id"), F.when(normal_key(F.col("gsm_id")).isNotNull(), F.col("gsm_id")).alias("gsm_id"))
    return P.match_status(ids, load(spark, d, "series").select(F.col("gse_id").alias("cohort_id")))


# --- graph and reports ---------------------------------------------------------------------------------------------
def _edges(spark, d):
    return load(spark, d, "series").select((F.col("row_id") / 3).cast("bigint").alias("parent"), F.col("row_id").alias("child")).where("child % 7 <> 0 and parent > 0").unionByName(spark.createDataFrame([(40, 1)], "parent bigint, child bigint"))


def graph_closure(spark, d):
    return G.closure(load(spark, d, "series").select(F.col("row_id").alias("id")), _edges(spark, d))


def graph_leaves(spark, d):
    return G.leaves(load(spark, d, "series").select(F.col("row_id").alias("id")), _edges(spark, d))


def orphans_anti(spark, d):
    members = load(spark, d, "series").select(F.col("row_id").alias("owner"), F.explode(F.split("platforms", ";")).alias("member"))
    return G.parent_orphans(members, _edges(spark, d))


def readiness_report(spark, d):
    s = load(spark, d, "series")
    cohorts = s.groupBy("gse_id").agg(F.max(F.when(F.col("n_samples") > 300, "P1")).alias("parent_series"))
    facts = load(spark, d, "annotation").groupBy("gse_id").agg(F.max("title").alias("title"), F.max("organism").alias("organism"), F.lit("microarray").alias("assay_type"), F.count(F.lit(1)).alias("n_samples"), F.max("expression_status").alias("expression_status"), F.concat("gse_id", F.lit("/m.tsv")).alias("expression_file"), F.lit(True).alias("has_annotation"))
    parents = s.where("removed_at is not null").groupBy("gse_id").agg(F.lit("2 samples only in the parent").alias("orphan_note"))
    return R.readiness(cohorts, facts, parents, s.where("n_samples % 2 = 0").select("gse_id"))


def catalog_search(spark, d):
    s = load(spark, d, "series").where("removed_at is null")
    hits = R.search_page(s, R.catalog_predicate(title="carcinoma", organism="homo sapiens"), 50, 10, "row_id")
    return hits.select("row_id", "gse_id", "title", "total_hits")


def recall_search(spark, d):
    s = load(spark, d, "series").where(R.recall_predicate(["lymphoma", "leukemia"], "Homo sapiens"))
    return R.report_rows(s.withColumn("platforms", R.platform_ids(F.col("platforms")))).select("gse_id", "title", "platforms", "n_samples", "url")


def content_summary(spark, d):
    p = load(spark, d, "platform").select("platform_id", C.assay_type(F.col("technology"), F.col("title")).alias("array_content"))
    pairs = load(spark, d, "series").select("row_id", F.explode(F.split("platforms", ";")).alias("platform_id"))
    return R.content_summary(pairs.join(F.broadcast(p), "platform_id"), key="row_id")


def equal_width_histogram(spark, d):
    h = R.equal_width_histogram(load(spark, d, "lineitem"), "l_extendedprice", 40)
    return h.select("bin", F.round("low", 4).alias("low"), F.round("high", 4).alias("high"), "n")


# --- statistics ----------------------------------------------------------------------------------------------------
def _features(spark, d):
    e = load(spark, d, "embeddings")
    return e.select(F.posexplode("embedding").alias("feature_id", "value"), F.col("vec_id").alias("sample_id"), "label").withColumn("value", F.col("value").cast("double"))


def _groups(spark, d):
    return load(spark, d, "embeddings").select(F.col("vec_id").alias("sample_id"), F.when(F.col("label") < 5, "a").otherwise("b").alias("group"), (F.col("label") % 2).cast("string").alias("batch"))


def ols_two_group(spark, d):
    """Coefficient, mean and ordinary t of each feature; one feature in ten lacks some cells."""
    f = _features(spark, d).select("feature_id", "sample_id", F.when((F.col("feature_id") % 10 > 0) | (F.col("sample_id") % 3 > 0), F.col("value")).alias("value"))
    fits = S.ordinary_t(S.linear_fits(f, S.design_of(_groups(spark, d), "group")))
    return fits.select("feature_id", *[F.round(c, 6).alias(c) for c in ("log_fc", "ave_expr", "t")])


def bh_adjust(spark, d):
    p = load(spark, d, "orders").select("o_orderkey", F.pow((F.col("o_totalprice") % 9973) / 9973, F.lit(2.0)).alias("p"))
    out = S.benjamini_hochberg(p, "p", "adj")
    return out.select("o_orderkey", F.round("adj", 6).alias("adj"))


def moderated_t(spark, d):
    return S.moderated_t(_features(spark, d).select("feature_id", "sample_id", "value"), S.design_of(_groups(spark, d), "group", ["batch"]))


QUERIES = {f.__name__: f for f in (
    classify_assay, classify_vendor, array_content, coverage_bucket, platform_gate, url_extension_filter, matrix_candidates, ranked_first, primary_by_name, primary_by_content, sample_count_fit, rnaseq_library, ordered_exclusion_reason,
    recist, event_remap, time_to_months, strip_label, species, expression_status, clinical_unify, clinical_protected, cluster_notes, open_mappings, answers_merged, id_map_merged, characteristics_map, json_props, platform_details, fingerprint_groups, fingerprint_join, vocab_normalize,
    column_profile, column_summary_topk, distinct_listagg, cluster_coalesce, union_schema_evolution, drop_parents, sample_property_filter, sample_id_match, positional_match, match_status,
    graph_closure, graph_leaves, orphans_anti, readiness_report, catalog_search, recall_search, content_summary, equal_width_histogram, ols_two_group, bh_adjust, moderated_t,
)}

_ASSAY = """case when regexp_matches(coalesce({0}, ''), '(?i)high.?throughput sequencing') then case when regexp_matches(coalesce(title, ''), '(?i)single.?cell|single.?nucle') then 'scrnaseq' else 'bulk_rnaseq' end
  when regexp_matches(coalesce({0}, ''), '(?i)oligonucleotide|spotted|in situ') then 'microarray' else 'other' end"""
_EVENT = """case when vital_status is null then null when lower(trim(vital_status)) in ('dead', 'deceased', '1') then '1' when lower(trim(vital_status)) in ('alive', '0') then '0'
  when contains(lower(vital_status), 'deceased') then '1' when contains(lower(vital_status), 'alive') then '0' when contains(lower(vital_status), 'dead') then '1'
  when contains(lower(vital_status), '0') then '0' when contains(lower(vital_status), '1') then '1' else vital_status end"""
_RECIST = """case when regexp_matches({0}, '(?i)complete response|^\\s*cr\\s*$') then 'CR' when regexp_matches({0}, '(?i)partial response|^\\s*pr\\s*$') then 'PR'
  when regexp_matches({0}, '(?i)stable disease|^\\s*sd\\s*$') then 'SD' when regexp_matches({0}, '(?i)progressive disease|progression|^\\s*pd\\s*$') then 'PD'
  when regexp_matches({0}, '(?i)not evaluable|not available|^\\s*(ne|na|n/a)\\s*$') then 'NE' end"""
_LABEL = "regexp_replace({0}, '^[A-Za-z][A-Za-z0-9 /_-]{{1,40}}:\\s+', '')"
_NAMES = "names as (select row_id, organism, gse_id || list_value('_TPM.txt.gz', '_counts.csv', '_FPKM_diff.tsv', '_GSM12_raw.txt', '_matrix.pdf', '_rpkm.xlsx', '_data.tsv')[row_id % 7 + 1] as name from series)"
_DATA = "regexp_matches(regexp_replace(lower(name), '\\.gz$', ''), '\\.(txt|tsv|csv|xlsx|xls)$')"
_CANDIDATE = f"({_DATA} and not regexp_matches(lower(name), 'gsm\\d+|diff|deg|significance|clinical|rmats|dexseq|novel_filtered|\\.original'))"
_RANK = "case when contains(lower(name), 'tpm') then 0 when contains(lower(name), 'fpkm') then 1 when contains(lower(name), 'rpkm') then 2 when contains(lower(name), 'cpm') then 3 when contains(lower(name), 'count') then 4 else 5 end"
_EDGES = "edges as (select cast(floor(row_id / 3) as bigint) as parent, row_id as child from series where row_id % 7 <> 0 and row_id >= 3 union all select 40, 1)"
_CLOSURE = f"""with recursive {_EDGES},
  walk as (select row_id as root, row_id as id, 0 as depth from series union select w.root, e.child, w.depth + 1 from walk w join edges e on w.id = e.parent where w.depth < 40),
  least as (select root, id, min(depth) as depth from walk group by all)"""
_MATCH = """
cols as (select gse_id as cohort_id, expression_id, min(row_id) as ord from sample_id_map where gse_id is not null group by all),
samples as (select gse_id as cohort_id, gsm_id, coalesce(min(title), 'nan') as title, coalesce(min(tissue), 'nan') as tissue, min(row_id) as ord from annotation where gse_id is not null and gsm_id is not null group by all),
norm as (select *, regexp_replace(lower(expression_id), '[^a-z0-9]+', '', 'g') as n from cols),
texts as (
  select cohort_id, gsm_id, 0 as place, title as text, regexp_replace(lower(title), '[^a-z0-9]+', '', 'g') as t from samples
  {second}),
hits as (
  select n.cohort_id, n.expression_id, 0 as level, -1 as place, s.gsm_id from norm n join samples s on n.cohort_id = s.cohort_id and n.expression_id = s.gsm_id
  union all select n.cohort_id, n.expression_id, 1, place, gsm_id from norm n join texts t on n.cohort_id = t.cohort_id and n.expression_id = t.text
  union all select n.cohort_id, n.expression_id, 2, place, gsm_id from norm n join texts t on n.cohort_id = t.cohort_id and n.n = t.t where n.n <> ''
  union all select n.cohort_id, n.expression_id, 3, place, gsm_id from norm n join texts t on n.cohort_id = t.cohort_id and contains(t.t, n.n) where n.n <> ''
  union all select n.cohort_id, n.expression_id, 4, place, gsm_id from norm n join texts t on n.cohort_id = t.cohort_id and t.t <> '' and contains(n.n, t.t) where n.n <> ''),
told as (select cohort_id, expression_id, level, place, max(gsm_id) as gsm_id from hits group by cohort_id, expression_id, level, place having count(*) = 1),
best as (select cohort_id, expression_id, min({{'l': level, 'p': place, 'g': gsm_id}}) as h from told group by all),
matched as (
  select c.cohort_id, c.expression_id, c.ord, h.g as gsm_id, coalesce(list_value('exact_gsm_id', 'exact', 'normalized_exact', 'substring', 'reverse_substring')[h.l + 1], 'unmatched') as match_method,
         coalesce(list_value(1.0::double, 0.95, 0.9, 0.75, 0.6)[h.l + 1], 0.0) as confidence from cols c left join best b on c.cohort_id = b.cohort_id and c.expression_id = b.expression_id)"""
_TISSUES = "union all select cohort_id, gsm_id, 1, tissue, regexp_replace(lower(tissue), '[^a-z0-9]+', '', 'g') from samples"

SQL = {
    "classify_assay": f"select platform_id, {_ASSAY.format('technology')} as assay_type from platform",
    "classify_vendor": "select platform_id, case when data_row_count > 40000 then 'illumina' when data_row_count is null then case when title is null then 'other' end else 'agilent' end as vendor from platform",
    "array_content": """with t as (select platform_id, title || list_value(' human miRNA', ' SNP 6.0', ' lncRNA and mRNA', ' long non-coding', '')[data_row_count % 5 + 1] as title from platform)
        select platform_id, case when regexp_matches(title, '(?i)copy number|\\bcgh\\b|\\bsnp\\b|genotyping array|\\bcnv\\b') then 'cna' when regexp_matches(title, '(?i)\\bmrna\\b|gene expression|whole transcriptome') then 'mrna'
        when regexp_matches(title, '(?i)\\bmirna\\b|micro.?rna') then 'mirna' when regexp_matches(title, '(?i)\\blncrna\\b|long non.?coding') then 'lncrna' else 'mrna' end as array_content from t""",
    "coverage_bucket": "select platform_id, case when coalesce(data_row_count, 0) <= 0 then 'unknown' when data_row_count >= 12000 then 'full_transcriptome' else 'limited' end as coverage from platform",
    "platform_gate": f"""with t as (select platform_id, {_ASSAY.format('technology')} as a, cast(floor(data_row_count / 3) as int) as n from platform),
        r as (select platform_id, case when a = 'microarray' and n > 0 and n < 8000 then 'only ' || n || ' rows' end as reason from t) select platform_id, reason is null as supported, reason from r""",
    "url_extension_filter": """with u as (select doc_id, unnest(regexp_extract_all(text, '((?:https?|ftp)://[A-Za-z0-9./?=&_-]*[A-Za-z0-9/])', 1)) as url from documents)
        select doc_id, count(*) as n_kept from u where length(url) % 3 = 2 or contains(url, '?') group by doc_id""",
    "matrix_candidates": f"""with {_NAMES}, t as (select *, {_RANK} as r from names) select row_id, {_DATA} as is_data, {_CANDIDATE} as is_candidate, r as unit_rank, list_value('tpm', 'fpkm', 'rpkm', 'cpm', 'count', 'unknown')[r + 1] as unit from t""",
    "ranked_first": f"with {_NAMES}, t as (select *, row_number() over (partition by organism order by {_RANK}, row_id) as k from names where {_CANDIDATE}) select organism, name, row_id from t where k = 1",
    "primary_by_name": "select row_id as cohort_id, 'b_FPKM.csv' as name, 'fpkm' as unit from series where n_samples is not null",
    "primary_by_content": """with t as (select row_id as c, n_samples % 40 + 6 as n, o, list_value('a_counts.tsv.gz', 'b_FPKM.csv', 'c.txt', 'GSM7_tpm.txt')[o + 1] as name from series, range(4) r(o) where n_samples is not null and o < 2 + row_id % 3 and o < 3),
        k as (select *, case when c % 5 * 600 >= 1000 and c % 9 > 0 then floor(n * (o + c % 2 + 1) / 3.0) end as cols from t),
        f as (select *, coalesce(n > 0 and abs(cols - n) <= greatest(5, round_even(n * 0.15::double, 0)), false) as fits from k),
        g as (select c, count(cols) as tables, count(*) filter (where fits) as nf, min(name) filter (where fits) as first, sum(cols) as s, max(n) as n, string_agg(name, ';' order by o) filter (where cols is not null) as parts from f group by c),
        v as (select *, nf = 1 as single, tables > 1 and coalesce(abs(s - n) <= greatest(5, round_even(n * 0.15::double, 0)), false) as multi from g)
        select c as cohort_id, case when single then 'single' when multi then 'multi_part' else 'none' end as verdict, case when single then first when multi then parts else '' end as names from v""",
    "sample_count_fit": "select row_id, n_samples > 0 and abs(row_id % 60 - 30) <= greatest(5, round_even(n_samples * 0.15::double, 0)) as fits from series",
    "rnaseq_library": "select row_id, case row_id % 4 when 0 then 'polyA' when 2 then 'total_rna' else case when tissue_detail is null then 'unknown' else 'total_rna' end end as library from sample_group",
    "ordered_exclusion_reason": """select p_partkey, case when p_size = 1 then 'mitochondrial' when p_size = 2 then 'replication_dependent_histone' when p_size = 3 then 'receptor_segment' when p_size = 4 then 'gene_not_coding' when p_size = 5 then 'flagged_gene'
        when p_size = 6 then 'transcript_not_coding' when p_size * 30 < 300 then 'too_short' when p_size % 11 = 0 then 'no_consensus_cds' when p_size = 23 then 'unreliable_remap' when p_size = 24 then 'several_mappings' end as reason from part""",
    "recist": f"select row_id, {_RECIST.format('trim(tumor_response)')} as recist from annotation",
    "event_remap": f"select row_id, {_EVENT} as event from annotation",
    "time_to_months": "select row_id, round(coalesce(try_cast(trim(raw_time) as double), try_cast(nullif(regexp_extract(raw_time, '(-?\\d+\\.?\\d*)', 1), '') as double)) / 30.4375, 6) as months from followup",
    "strip_label": f"select row_id, {_LABEL.format('vital_status')} as vital_status from annotation",
    "species": "select case when coalesce(lower(trim(organism)), '') in ('', 'unknown') then 'unknown' when regexp_matches(lower(organism), 'homo sapiens|human') then 'human' when regexp_matches(lower(organism), 'mus musculus|mouse|murine') then 'mouse' else 'other' end as species, count(*) as n from series group by 1",
    "expression_status": """select row_id, case when expression_status = 'no_expression_matrix' then 'no_expression_matrix' when coalesce(age < 85, true) = false then 'unparseable' else coalesce(nullif(concat_ws(';', case when sex = 'unknown' then 'two_channel_signal_unresolved' end,
        case when os_months > 50 then 'not_log2_transformed' end, case when tumor_response = 'PD' then 'negative_values' end, case when age > 80 then 'looks_transposed' end, case when expression_status = 'low_gene_count' then 'low_gene_count' end), ''), 'ok') end as status from annotation""",
    "clinical_unify": f"""with t as (select *, {_LABEL.format('tumor_response')} as tr, {_LABEL.format('vital_status')} as vs from annotation),
        u as (select row_id, concat_ws('; ', {_LABEL.format('drug')}, {_LABEL.format('tissue')}) as treatment, concat_ws('; ', {_LABEL.format('dose_schedule')}) as treatment_detail, tr as response, {_RECIST.format('trim(tr)')} as recist, round(os_months, 6) as "OS_time", vs as vital_status from t)
        select row_id, treatment, treatment_detail, response, recist, "OS_time", {_EVENT} as "OS_event" from u""",
    "clinical_protected": f"""select row_id, gsm_id, gse_id, platform_id, {_LABEL.format('sex')} as sex, coalesce({_LABEL.format('drug')}, '') as treatment, coalesce({_LABEL.format('dose_schedule')}, '') as treatment_detail,
        {_LABEL.format('tumor_response')} as response, {_RECIST.format('trim(' + _LABEL.format('tumor_response') + ')')} as recist, round(os_months / 30.4375, 6) as "OS_time", {_LABEL.format('vital_status')} as "OS_event",
        'OS_event: the meaning of its values (''unclear'') can''t be read; they are left as they are' as notes from annotation""",
    "cluster_notes": """select 'sex' as canonical_name, 'several_values' as note, 'sex_a, sex_b' as value, count(*) as n_rows from annotation where row_id % 2 = 0 and sex is not null having count(*) > 0
        union all select 'sex', 'unmapped', sex, count(*) from annotation where lower(trim(sex)) not in ('f', 'm') group by sex union all select 'response', 'name_taken', 'tumor_response', 0""",
    "open_mappings": """with v as (select sex as v from annotation where row_id % 2 = 0 and sex is not null union all select vital_status from annotation where vital_status is not null), c as (select v, count(*) as n from v group by v)
        select 'sex' as canonical_name, v as value, n as n_rows from c where (select count(*) from c) > 1 and (select count(*) from c where lower(trim(v)) not in ('f', 'm')) > 0""",
    "answers_merged": """with g as (select *, row_number() over (partition by gse_id order by diagnosis nulls first, prior_therapy nulls first) as k from sample_group)
        select a.row_id, a.gse_id, g.diagnosis as llm_diagnosis, g.prior_therapy as llm_prior_therapy from annotation a left join g on a.gse_id = g.gse_id and g.k = 1""",
    "id_map_merged": """with m as (select *, row_number() over (partition by gse_id, gsm_id order by confidence desc nulls first, expression_id nulls first, match_method nulls first) as k from sample_id_map where gsm_id is not null)
        select a.row_id, a.gse_id, a.gsm_id, m.expression_id, m.match_method as id_match_method, m.confidence as id_match_confidence from annotation a left join m on a.gse_id = m.gse_id and a.gsm_id = m.gsm_id and m.k = 1""",
    "characteristics_map": """select row_id, 'sex' as key, trim(coalesce(sex, '')) as value from annotation union all select row_id, 'drug', trim(coalesce(drug, '')) from annotation union all select row_id, 'drug_2', trim(coalesce(dose_schedule, '')) from annotation
        union all select row_id, lower(trim(split_part(coalesce(tissue, 'no tissue'), ':', 1))), case when contains(tissue, ':') then trim(regexp_replace(tissue, '^[^:]*:', '')) else '' end from annotation""",
    "json_props": "select event_id, cast(json_extract(props, '$.k') as int) as k from events",
    "platform_details": """with p as (select row_id, unnest(from_json(platform_details, '[{"platform_id": "VARCHAR", "assay_type": "VARCHAR"}]')) as p from series)
        select s.row_id, coalesce(string_agg(distinct p.assay_type, ';' order by p.assay_type), '') as assay_type, coalesce(string_agg(distinct p.platform_id, ';' order by p.platform_id), '') as platforms from series s left join p using (row_id) group by s.row_id""",
    "fingerprint_groups": "select platform_id, count(*) as n_samples, min(gsm_id) as first_sample from annotation group by platform_id, coalesce(sex, ''), coalesce(tumor_response, ''), coalesce(expression_status, '')",
    "fingerprint_join": "with g as (select gse_id, max(tissue_class) as tissue_class, max(prior_therapy_detail) as prior_therapy_detail from sample_group group by gse_id) select a.gse_id, a.row_id, coalesce(tissue_class, 'unknown') as tissue_class, coalesce(prior_therapy_detail, '') as prior_therapy_detail from annotation a left join g using (gse_id)",
    "vocab_normalize": "with t as (select lower(trim(canonical_value)) as k, min(canonical_value) as t from canonical_value group by 1) select row_id, raw_value, coalesce(t, 'other') as normalized, t is not null as matched from value_mapping_entry left join t on lower(trim(raw_value)) = k",
    "column_profile": """with l as (select 'sex' as column_name, sex as v from annotation union all select 'tissue', tissue from annotation union all select 'organism', organism from annotation union all select 'age', cast(age as varchar) from annotation
        union all select 'drug', drug from annotation union all select 'os_months', cast(os_months as varchar) from annotation union all select 'constant', 'x' from annotation),
        s as (select column_name, count(*) as n_rows, count(distinct v) as n_distinct, count(*) - count(v) as n_null, coalesce(count(try_cast(v as double)) / nullif(count(v), 0), 0) as share from l group by all)
        select column_name, n_rows, n_distinct, n_null, round(share, 6) as numeric_share, n_distinct + (n_null > 0)::int <= 1 as is_constant, share >= 0.9 as is_numeric, n_distinct > 12 as is_high_cardinality from s""",
    "column_summary_topk": """with l as (select platform_id as c, 'sex' as column_name, sex as v from annotation union all select platform_id, 'tissue', tissue from annotation union all select platform_id, 'expression_status', expression_status from annotation),
        k as (select *, row_number() over (partition by column_name order by n desc, v) as r from (select column_name, v, count(*) as n from l where v is not null group by all)),
        e as (select column_name, string_agg(v || '=' || n, '; ' order by r) as examples from k where r <= 5 group by all)
        select column_name, cohorts, examples from (select column_name, string_agg(distinct c, ';' order by c) as cohorts from l where v is not null group by all) join e using (column_name)""",
    "distinct_listagg": "select gse_id, string_agg(distinct tissue_class, ', ' order by tissue_class) as tissues from sample_group where tissue_class <> 'unknown' group by gse_id",
    "cluster_coalesce": "select row_id, case lower(trim(sex)) when 'f' then 'female' when 'm' then 'male' else sex end as sex, tumor_response as response from annotation",
    "union_schema_evolution": "select gsm_id, gse_id, sex, age, null as diagnosis, null as tissue_class from annotation union all select null, gse_id, null, null, diagnosis, tissue_class from sample_group",
    "drop_parents": "select row_id, gse_id from annotation where gse_id is null or gse_id not in (select gse_id from series where removed_at is not null)",
    "sample_property_filter": """with h as (select gse_id, count(*) as n, count(*) filter (where contains(lower(coalesce(sex, '')), 'female')) as a,
        count(*) filter (where contains(lower(concat_ws(' | ', coalesce(sex, ''), coalesce(drug, ''), coalesce(dose_schedule, ''), case when contains(tissue, ':') then tissue else '' end)), 'velotinib')) as b from annotation group by gse_id)
        select gse_id, 'sex:female=' || a || '/' || n || '; cell line:velotinib=' || b || '/' || n as matches from h where a > 0 and b > 0 and gse_id is not null""",
    "sample_id_match": "with " + _MATCH.format(second=_TISSUES).strip() + " select cohort_id, expression_id, gsm_id, match_method, confidence from matched",
    "positional_match": "with " + _MATCH.format(second="").strip() + """,
        m as (select * from matched),
        free as (select s.cohort_id, s.gsm_id, row_number() over (partition by s.cohort_id order by s.ord, s.gsm_id) as p, count(*) over (partition by s.cohort_id) as n from samples s
                 where s.cohort_id in (select cohort_id from m) and not exists (select 1 from m where m.cohort_id = s.cohort_id and m.gsm_id = s.gsm_id)),
        opened as (select cohort_id, expression_id, row_number() over (partition by cohort_id order by ord, expression_id) as p, count(*) over (partition by cohort_id) as n from m where gsm_id is null),
        given as (select o.cohort_id, o.expression_id, f.gsm_id from opened o join free f on o.cohort_id = f.cohort_id and o.p = f.p and o.n = f.n)
        select m.cohort_id, m.expression_id, coalesce(m.gsm_id, g.gsm_id) as gsm_id, case when g.gsm_id is not null then 'positional_fallback' else match_method end as match_method, case when g.gsm_id is not null then 0.5 else confidence end as confidence
        from m left join given g on m.cohort_id = g.cohort_id and m.expression_id = g.expression_id""",
    "match_status": """with c as (select gse_id, count(*) as n, count(nullif(nullif(nullif(upper(trim(gsm_id, E' \\t\\n')), ''), '---'), 'NONE')) as m from sample_id_map group by gse_id)
        select s.gse_id as cohort_id, case when n is null then 'not_available' when n = m then 'matched' else 'needs_review' end as status, coalesce(m || '/' || n || ' matched', '') as detail from (select distinct gse_id from series) s left join c using (gse_id)""",
    "graph_closure": _CLOSURE + " select l.root, l.id, (select min(p.id) from edges e join least p on p.id = e.parent and p.root = l.root and p.depth = l.depth - 1 where e.child = l.id) as parent, l.depth from least l",
    "graph_leaves": _CLOSURE + " select root, id from least where id not in (select parent from edges)",
    "orphans_anti": f"""with {_EDGES}, members as (select row_id as owner, unnest(string_split(platforms, ';')) as member from series),
        own as (select distinct owner as parent, member from members where owner in (select parent from edges)), kids as (select distinct e.parent, m.member from edges e join members m on e.child = m.owner)
        select * from own except select * from kids""",
    "readiness_report": """with c as (select gse_id, max(case when n_samples > 300 then 'P1' end) as parent_series, bool_or(n_samples % 2 = 0) as asked, bool_or(removed_at is not null) as par from series group by gse_id),
        f as (select gse_id, max(title) as title, max(organism) as organism, count(*) as n, max(expression_status) as st from annotation where gse_id is not null group by gse_id)
        select c.gse_id, coalesce(parent_series, '') as parent_series, coalesce(asked, false) as in_requested_list, f.gse_id is not null as downloaded, coalesce(title, '') as title, coalesce(organism, '') as organism, case when f.gse_id is null then '' else 'microarray' end as assay_type,
        coalesce(st, '') as expression_status, n as n_samples, case when st = 'ok' then 'ready' else 'not_ready' end as readiness, case when st = 'ok' then c.gse_id || '/m.tsv' else '' end as expression_file,
        concat_ws('; ', case when f.gse_id is null then 'not downloaded yet' when st = 'ok' then null when coalesce(st, '') = '' then 'no expression_status recorded' else st end, case when f.gse_id is not null and par then '2 samples only in the parent' end) as reason_if_not_ready
        from c left join f on c.gse_id = f.gse_id""",
    "catalog_search": """with h as (select row_id, gse_id, title, count(*) over () as total_hits from series where removed_at is null and contains(lower(title), 'carcinoma') and contains(lower(organism), 'homo sapiens'))
        select * from h order by row_id limit 50 offset 10""",
    "recall_search": """select coalesce(gse_id, '') as gse_id, coalesce(title, '') as title, coalesce(array_to_string(list_transform(list_filter(string_split(coalesce(platforms, ''), ';'), lambda x: trim(x) <> ''), lambda x: regexp_replace(trim(x), '^(?:GPL)?', 'GPL')), ';'), '') as platforms,
        coalesce(cast(n_samples as varchar), '') as n_samples, 'https://www.ncbi.nlm.nih.gov/geo/query/acc.cgi?acc=' || coalesce(gse_id, '') as url from series
        where (contains(lower(concat_ws(' ', title, summary)), 'lymphoma') or contains(lower(concat_ws(' ', title, summary)), 'leukemia')) and contains(lower(coalesce(organism, '')), 'homo sapiens')""",
    "content_summary": f"""with p as (select platform_id, {_ASSAY.format('technology')} as a from platform), s as (select row_id, unnest(string_split(platforms, ';')) as platform_id from series)
        select row_id, string_agg(distinct a, ';' order by a) as array_content from s join p using (platform_id) group by row_id""",
    "equal_width_histogram": """with b as (select min(l_extendedprice) as a, max(l_extendedprice) as z, (max(l_extendedprice) - min(l_extendedprice)) / 40 as w from lineitem),
        t as (select cast(greatest(1, least(ceil((l_extendedprice - a) / w), 40)) as int) as bin, a, w from lineitem, b) select bin, round(a + (bin - 1) * w, 4) as low, round(a + bin * w, 4) as high, count(*) as n from t group by bin, a, w""",
    "ols_two_group": """with v as (select vec_id, unnest(embedding)::double as y, generate_subscripts(embedding, 1) - 1 as feature_id, case when label < 5 then 0.0 else 1.0 end as x from embeddings),
        k as (select * from v where feature_id % 10 > 0 or vec_id % 3 > 0),
        s as (select feature_id, regr_slope(y, x) as b, avg(y) as m, regr_sxx(y, x) as sxx, greatest(regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x), 0) / (count(*) - 2) as s2 from k group by feature_id)
        select cast(feature_id as int) as feature_id, round(b, 6) as log_fc, round(m, 6) as ave_expr, round(b / nullif(sqrt(s2 / sxx), 0), 6) as t from s""",
    "bh_adjust": """with p as (select o_orderkey, pow(fmod(o_totalprice, 9973) / 9973, 2) as p from orders), r as (select p, count(*) as k from p group by p), c as (select p, sum(k) over (order by p) as rank, (select count(*) from p) as n from r),
        a as (select p, min(least(p * n / rank, 1)) over (order by p desc rows unbounded preceding) as adj from c) select o_orderkey, round(adj, 6) as adj from p join a using (p)""",
}
