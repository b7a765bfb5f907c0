"""Queries of the matrix and identifier operators, with line items as cells: part = feature, supplier = sample, region = cohort."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions.identifiers import assigned_entrez, assigned_symbol, first_of_packed, strip_version
from cohortloom.operators import identifiers as I
from cohortloom.operators import intake as T
from cohortloom.operators import matching as P
from cohortloom.operators import matrix as M
from cohortloom.operators.finalize import finalize_report, finalized
from cohortloom.session import cut_lineage, load


def cells(spark: SparkSession, d: str, agg=F.avg) -> DataFrame:
    """Cells of five cohorts, in log scale (of the quantity) in the even ones and linear (the price) in the odd.

    No value is a short decimal, so that no rounded result hangs on a tie.
    """
    items, supplier, nation = load(spark, d, "lineitem"), load(spark, d, "supplier"), load(spark, d, "nation")
    where = supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), "n_regionkey")
    value = F.when(F.col("n_regionkey") % 2 == 0, F.log2(F.col("l_quantity") + 1)).otherwise(F.col("l_extendedprice") * 1.0003719)
    return (
        items.select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
        .join(where, "l_suppkey")
        .groupBy(F.col("n_regionkey").cast("string").alias("cohort_id"), F.col("l_partkey").cast("string").alias("feature_id"), F.col("l_suppkey").cast("string").alias("sample_id"))
        .agg(agg(value).alias("value"))
    )


def ready(spark: SparkSession, d: str) -> DataFrame:
    """The cells written, for operators that read them more than once."""
    return cut_lineage(cells(spark, d))


def brands(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "part").select(F.col("p_partkey").cast("string").alias("feature_id"), F.col("p_brand").alias("symbol"))


def probe_map(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "part").select(F.col("p_partkey").alias("probe_id"), F.col("p_brand").alias("gene_symbol"), F.lit(None).cast("string").alias("entrez_id"))


def lengths(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "part").select(F.col("p_partkey").cast("string").alias("feature_id"), (F.col("p_size") * 100).alias("length"))


def small_parts(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "part").where("p_size > 25").select(F.col("p_partkey").cast("string").alias("feature_id"))


def _r(df: DataFrame, places: int = 4) -> DataFrame:
    return df.withColumn("value", F.round("value", places))


def probe_to_gene_mean(spark, d):
    return _r(M.probes_to_genes(cells(spark, d), probe_map(spark, d)).select("cohort_id", "gene_key", "sample_id", "value"), 5)


def probe_to_gene_join(spark, d):
    return _r(M.map_probes(cells(spark, d), probe_map(spark, d)).select("cohort_id", "feature_id", "gene_key", "sample_id", "value"))


def symbol_sum_collapse(spark, d):
    return _r(M.symbol_sums(cells(spark, d), brands(spark, d)), 4)


def tpm(spark, d):
    return _r(M.tpm(cells(spark, d), lengths(spark, d)), 3)


def renorm_1e6(spark, d):
    return _r(M.per_million(cells(spark, d)), 3)


def restrict_clean(spark, d):
    return _r(M.restricted(cells(spark, d), small_parts(spark, d)))


def needs_log2(spark, d):
    return M.scale_facts(cells(spark, d)).select("cohort_id", F.round("max_value", 4).alias("max_value"), "needs_log2")


def integer_like(spark, d):
    return M.scale_facts(cells(spark, d)).select("cohort_id", "integer_like")


def maybe_log2(spark, d):
    return _r(M.log2_where_linear(ready(spark, d)))


def to_linear(spark, d):
    return _r(M.linear_scale(ready(spark, d)))


def matrix_qc(spark, d):
    return M.matrix_qc(cells(spark, d))


def low_feature_count(spark, d):
    return M.low_feature_count(cells(spark, d).where("cohort_id <> '2' or cast(feature_id as int) % 3 = 0"), 1000)


def normalize_matrix(spark, d):
    return _r(M.normalized(ready(spark, d)))


def quantile_normalize(spark, d):
    return _r(M.quantile_normalized(cells(spark, d, F.max)), 6)


def _by_gene(spark, d, status):
    part = load(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", F.when(F.col("p_size") > 10, F.col("p_type")).alias("p_type"))
    return load(spark, d, "lineitem").where(F.col("l_linestatus") == status).join(part, "l_partkey").groupBy("p_brand", "p_type").agg(F.avg("l_quantity").alias("value"))


def gene_frames_full_outer(spark, d):
    out = M.gene_frames_joined(_by_gene(spark, d, "O").where("p_brand <> 'Brand#11'"), _by_gene(spark, d, "F").where("p_brand <> 'Brand#12'"), ["p_brand", "p_type"])
    return out.withColumn("left_value", F.round("left_value", 4)).withColumn("right_value", F.round("right_value", 4))


def companion_coalesce(spark, d):
    half = lambda s: load(spark, d, "lineitem").where(F.col("l_linestatus") == s).groupBy("l_partkey", "l_suppkey").agg(F.avg("l_quantity").alias("value"))
    return _r(M.combined_first(half("O"), half("F"), ["l_partkey", "l_suppkey"]))


def _maps(spark, d):
    part = load(spark, d, "part")
    one = part.where("p_size <= 30").select(F.col("p_partkey").alias("probe_id"), F.col("p_brand").alias("gene_symbol"))
    return one, part.where("p_size >= 20").select(F.col("p_partkey").alias("probe_id"), F.col("p_type").alias("gene_symbol"))


def union_first_wins(spark, d):
    return M.first_map_wins(list(_maps(spark, d)))


def multi_platform_expression(spark, d):
    united = M.first_map_wins(list(_maps(spark, d))).withColumn("entrez_id", F.lit(None).cast("string"))
    genes = cut_lineage(M.probes_to_genes(cells(spark, d), united).select("cohort_id", F.col("gene_key").alias("feature_id"), "sample_id", "value"))
    return _r(M.log2_where_linear(genes, keep_negative=True), 6)


def reference_channel(spark, d):
    items, supplier, nation = load(spark, d, "lineitem"), load(spark, d, "supplier"), load(spark, d, "nation")
    where = supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_regionkey").cast("string").alias("cohort_id"))
    both = F.array(F.struct(F.lit(1).alias("channel"), F.col("q").alias("value")), F.struct(F.lit(2).alias("channel"), F.col("p").alias("value")))
    mean = items.join(where, "l_suppkey").groupBy("cohort_id", F.col("l_partkey").alias("feature_id"), F.col("l_suppkey").alias("sample_id")).agg(F.avg("l_quantity").alias("q"), F.avg("l_extendedprice").alias("p"))
    out = M.reference_channel(mean.select("cohort_id", "feature_id", "sample_id", F.explode(both).alias("c")).select("cohort_id", "feature_id", "sample_id", "c.*"))
    return out.select("cohort_id", F.round("var1", 5).alias("var1"), F.round("var2", 5).alias("var2"), "reference_channel", "signal_channel", "method")


def _chips(spark, d):
    s = load(spark, d, "supplier")
    titled = lambda platform, word: s.select(F.col("s_nationkey").alias("cohort_id"), F.concat(F.lit(word[0]), F.col("s_suppkey").cast("string")).alias("sample_id"), P.companion_title(F.concat("s_name", F.lit(f" HG-U133{word}")), platform).alias("pair_key"), F.col("s_suppkey"))
    return titled("GPL96", "A"), titled("GPL97", "B").where("s_suppkey % 40 <> 7").drop("s_suppkey")


def companion_pairing(spark, d):
    left, right = _chips(spark, d)
    return P.paired_samples(left.drop("s_suppkey"), right)


def pair_collapse(spark, d):
    left, right = _chips(spark, d)
    rows = left.select("cohort_id", "sample_id", F.lit("GPL96").alias("platform_id")).unionByName(right.select("cohort_id", "sample_id", F.lit("GPL97").alias("platform_id")))
    return P.collapsed_pairs(rows, P.paired_samples(left.drop("s_suppkey"), right))


def strategy_cascade(spark, d):
    return I.probe_gene_map(load(spark, d, "platform_probe"))


def first_of_packed_cell(spark, d):
    return load(spark, d, "platform_probe").select("row_id", first_of_packed(F.col("gene_symbol")).alias("symbol"), first_of_packed(F.col("entrez_gene_id")).alias("entrez_id"))


def packed_record_parse(spark, d):
    return load(spark, d, "platform_probe").select("row_id", assigned_symbol(F.col("gene_assignment")).alias("symbol"), assigned_entrez(F.col("gene_assignment")).alias("entrez_id"))


def identifier_type(spark, d):
    ids = load(spark, d, "part").select(F.col("p_brand").alias("cohort_id"), F.when(F.col("p_brand").endswith("1"), F.concat(F.lit("ENSG0000"), F.col("p_partkey").cast("string"), F.lit(".3"))).when(F.col("p_brand").endswith("2"), F.concat(F.lit("ENST0000"), F.col("p_partkey").cast("string"), F.lit(".1|x"))).otherwise(F.col("p_name")).alias("feature_id"))
    known = load(spark, d, "part").where("p_size > 30").select(F.col("p_name").alias("symbol"))
    return I.identifier_type(ids, known)


def strip_version_id(spark, d):
    return load(spark, d, "platform_probe").select("row_id", strip_version(F.col("gene_symbol")).alias("symbol"))


def undouble_symbols(spark, d):
    ids = load(spark, d, "part").select(F.col("p_brand").alias("cohort_id"), F.when((F.col("p_partkey") % 3 > 0) & F.col("p_brand").endswith("3"), F.concat("p_type", F.lit("_"), "p_type")).otherwise(F.col("p_type")).alias("feature_id"), "p_partkey")
    return I.undoubled_ids(ids)


def gene_length_median(spark, d):
    t = load(spark, d, "part").select(F.concat("p_brand", F.lit(".7")).alias("gene_id"), F.col("p_size").alias("transcript_length"), (F.col("p_size") > 5).alias("included"))
    return I.gene_lengths(t)


def _units(spark, d):
    return spark.createDataFrame([("0", "count"), ("1", "fpkm"), ("2", None), ("3", "count"), ("4", "tpm"), ("9", "count")], "cohort_id string, unit string")


def _gene_lengths(spark, d):
    return load(spark, d, "part").groupBy(F.col("p_brand").alias("feature_id")).agg((F.avg("p_size") * 100).alias("length"))


def _clean_brands(spark, d):
    return load(spark, d, "part").where("p_brand not in ('Brand#11', 'Brand#55')").select(F.col("p_brand").alias("feature_id")).distinct()


def finalize_rows(spark, d):
    return finalize_report(ready(spark, d), _units(spark, d), brands(spark, d), _gene_lengths(spark, d), _clean_brands(spark, d))


def finalize_cells(spark, d):
    return finalized(ready(spark, d), _units(spark, d), brands(spark, d), _gene_lengths(spark, d), _clean_brands(spark, d))


# --- matrix files as rows of cells ---------------------------------------------------------------------------------
def _table(spark, d, path, header, *values):
    """A file of all parts: its header and a row a part."""
    text = lambda v: (v if not isinstance(v, str) else F.col(v)).cast("string")
    body = load(spark, d, "part").select(F.lit(path).alias("path"), F.lit("").alias("member"), (F.col("p_partkey") + 1).cast("long").alias("row_ord"), F.array(*[text(v) for v in values]).alias("cells"), F.lit(None).cast("string").alias("error"))
    return body.unionByName(spark.createDataFrame([(path, "", 0, header, None)], "path string, member string, row_ord long, cells array<string>, error string"))


_MESSY = {
    "/t/annotated.tsv": (["gene_id", "Symbol", "chr", "#", "S1", "S2", "fold_change"], ["p_partkey", "p_brand", F.lit, "p_partkey", "p_size", "p_retailprice", "p_size"]),
    "/t/unnamed.tsv": (["S1", "S2"], ["p_name", "p_size", "p_retailprice"]),
    "/t/two_headers.tsv": (["a", "b", "c", "d", "e"], ["p_name", "p_brand", "p_type", "p_type", "p_size"]),
    "/t/texts.tsv": (["probe", "S1", "S2", "S3"], ["p_partkey", "p_size", "p_type", "p_retailprice"]),
}


def _messy(spark, d):
    out = None
    for path, (header, values) in _MESSY.items():
        part = _table(spark, d, path, header, *[F.lit("chr1") if v is F.lit else F.when(F.col("p_size") == 7, "NA").otherwise(F.col(v).cast("string")) if v == "p_size" else v for v in values])
        out = part if out is None else out.unionByName(part)
    return out


def metadata_drop(spark, d):
    plan = T.intake_plan(_messy(spark, d), ["path", "member"])
    return plan.select("path", "id_column", F.size("samples").alias("n_samples"), F.array_join("dropped", ", ").alias("dropped"), "status", "n_rows")


def intake_cells(spark, d):
    rows, keys = cut_lineage(_messy(spark, d)), ["path", "member"]
    return _r(T.intake_cells(rows, T.intake_plan(rows, keys), keys).drop("member"))


def identifier_axis(spark, d):
    gene = F.concat(F.lit("ENSG0000"), F.col("p_partkey").cast("string"), F.lit(".2"))
    rows = _table(spark, d, "/t/both.tsv", ["Gene_name", "Gene_stable_ID", "S1"], "p_name", gene, "p_size").unionByName(_table(spark, d, "/t/doubled.tsv", ["x", "S1"], F.concat("p_name", F.lit("_"), "p_name"), "p_size"))
    rows = rows.unionByName(_table(spark, d, "/t/none.tsv", ["gene_id", "S1"], F.concat(F.lit("XLOC_"), "p_partkey"), "p_size"))
    return T.identifier_axes(rows, load(spark, d, "part").where("p_size > 30").select(F.col("p_name").alias("symbol")), ["path"])


def _cohort_files(spark, d):
    rows = _table(spark, d, "/data/C0/a_counts.tsv", ["gene", "S1"], "p_partkey", "p_size").unionByName(_table(spark, d, "/data/C0/b_TPM.tsv", ["gene", "chr", "S1", "S2"], "p_partkey", F.lit("1"), "p_size", "p_retailprice"))
    rows = rows.unionByName(_table(spark, d, "/data/C1/all_diff.tsv", ["gene", "S1"], "p_partkey", "p_size")).unionByName(_table(spark, d, "/data/C2/data.txt", ["gene", "S1", "S2"], "p_partkey", F.col("p_size") / 50, F.col("p_size") / 100))
    return cut_lineage(rows), spark.createDataFrame([("C0", 2), ("C1", 2), ("C2", 2)], "cohort_id string, n_samples int")


def primary_matrix(spark, d):
    return T.primary_matrices(*_cohort_files(spark, d))[0].select("cohort_id", "path", "unit", "status", "truncated")


def primary_matrix_cells(spark, d):
    return _r(T.primary_matrices(*_cohort_files(spark, d))[1])


QUERIES = {f.__name__: f for f in (
    probe_to_gene_mean, probe_to_gene_join, symbol_sum_collapse, tpm, renorm_1e6, restrict_clean, needs_log2, integer_like, maybe_log2, to_linear, matrix_qc, low_feature_count, normalize_matrix,
    quantile_normalize, gene_frames_full_outer, companion_coalesce, union_first_wins, multi_platform_expression, reference_channel, companion_pairing, pair_collapse, strategy_cascade,
    packed_record_parse, identifier_type, undouble_symbols, gene_length_median, finalize_cells, metadata_drop, intake_cells, identifier_axis, primary_matrix, primary_matrix_cells,
)} | {"first_of_packed": first_of_packed_cell, "strip_version": strip_version_id, "finalize_report": finalize_rows}

_CELLS = """
with cells as (
  select cast(n_regionkey as varchar) as cohort_id, cast(l_partkey as varchar) as feature_id, cast(l_suppkey as varchar) as sample_id,
         avg(case when n_regionkey % 2 = 0 then log2(l_quantity + 1) else l_extendedprice * 1.0003719 end) as value
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by all),
flags as (select cohort_id, max(value) > 50 as needs_log2 from cells group by cohort_id)"""
_FIRST = "case when trim({0}) not in ('', '---') then trim(split_part(trim({0}), ' /// ', 1)) end"
_RECORD = """
rec as (
  select row_id, min(i) as i from (
    select row_id, unnest(string_split(gene_assignment, ' /// ')) as r, generate_subscripts(string_split(gene_assignment, ' /// '), 1) as i from platform_probe)
  where len(regexp_split_to_array(trim(r), '\\s*//\\s*')) >= 2 and trim(regexp_split_to_array(trim(r), '\\s*//\\s*')[2]) not in ('', '---') group by row_id),
parsed as (
  select p.row_id, list_transform(regexp_split_to_array(trim(string_split(p.gene_assignment, ' /// ')[rec.i]), '\\s*//\\s*'), lambda x: trim(x)) as f
  from platform_probe p left join rec on p.row_id = rec.row_id)"""
_PAIRS = """
with sides as (
  select s_nationkey as cohort_id, lower(s_name) as pair_key, 'A' || s_suppkey as left_id, null as right_id from supplier
  union all select s_nationkey, lower(s_name), null, 'B' || s_suppkey from supplier where s_suppkey % 40 <> 7),
keys as (select cohort_id, pair_key, count(left_id) as nl, count(right_id) as nr, max(left_id) as left_id, max(right_id) as right_id from sides group by all),
good as (select cohort_id from keys group by cohort_id having bool_and(nl = 1 and nr = 1 and pair_key <> '')),
pairs as (select k.cohort_id, k.pair_key, k.left_id, k.right_id from keys k join good using (cohort_id))"""
_LINEAR = """,
linear as (select cohort_id, feature_id, sample_id, greatest(case when needs_log2 then value else pow(2, value) - 1 end, 0) as value from cells join flags using (cohort_id)),
units as (select * from (values ('0', 'count'), ('1', 'fpkm'), ('2', null), ('3', 'count'), ('4', 'tpm'), ('9', 'count')) t(cohort_id, unit)),
named as (select cohort_id, p_brand as feature_id, sample_id, sum(value) as value from linear join part on feature_id = cast(p_partkey as varchar) group by all),
lens as (select p_brand as feature_id, avg(p_size) * 100 as length from part group by all),
rate as (select n.cohort_id, n.feature_id, n.sample_id, n.value / (length / 1000) as value from named n join units u using (cohort_id) join lens using (feature_id) where u.unit in ('count', 'cpm')),
scaled as (
  select cohort_id, feature_id, sample_id, value / (sum(value) over (partition by cohort_id, sample_id) / 1e6) as value from rate
  union all select n.cohort_id, n.feature_id, n.sample_id, n.value from named n join units u using (cohort_id) where u.unit not in ('count', 'cpm')),
kept as (select * from scaled where feature_id not in ('Brand#11', 'Brand#55')),
million as (select cohort_id, feature_id, sample_id, value / sum(value) over (partition by cohort_id, sample_id) * 1e6 as value from kept),
final as (select cohort_id, feature_id, sample_id, round(case when max(value) over (partition by cohort_id) > 50 then log2(value + 1) else value end, 3) as value from million)
"""
_NA_SIZE = "case when p_size <> 7 then p_size end"
SQL = {
    "metadata_drop": """select path, id_column, n_samples, dropped, status, (select count(*) from part) as n_rows from (values ('/t/annotated.tsv', 'Symbol', 2, 'gene_id, chr, #, fold_change', 'ok'), ('/t/unnamed.tsv', 'gene_id', 2, '', 'ok'),
        ('/t/two_headers.tsv', 'a', 1, '', 'refused'), ('/t/texts.tsv', 'probe', 2, 'S2', 'ok')) t(path, id_column, n_samples, dropped, status)""",
    "intake_cells": f"""with c as (select '/t/annotated.tsv' as path, p_brand as feature_id, 'S1' as sample_id, {_NA_SIZE} as value from part union all select '/t/annotated.tsv', p_brand, 'S2', p_retailprice from part
        union all select '/t/unnamed.tsv', p_name, 'S1', {_NA_SIZE} from part union all select '/t/unnamed.tsv', p_name, 'S2', p_retailprice from part
        union all select '/t/texts.tsv', cast(p_partkey as varchar), 'S1', {_NA_SIZE} from part union all select '/t/texts.tsv', cast(p_partkey as varchar), 'S3', p_retailprice from part)
        select path, feature_id, sample_id, round(cast(value as double), 4) as value from c""",
    "identifier_axis": "select * from (values ('/t/both.tsv', 2, 'Gene_stable_ID', 'gene'), ('/t/doubled.tsv', 1, 'x', 'symbol')) t(path, place, name, id_type)",
    "primary_matrix": """with n as (select count(*) as n from part) select 'C0' as cohort_id, '/data/C0/b_TPM.tsv' as path, 'tpm' as unit, 'ok' as status, n < 16000 as truncated from n
        union all select 'C1', null, null, 'none', false union all select 'C2', case when n >= 1000 then '/data/C2/data.txt' end, case when n >= 1000 then 'unknown' end, case when n >= 1000 then 'ok' else 'none' end, n >= 1000 and n < 16000 from n""",
    "primary_matrix_cells": """with c as (select 'C0' as cohort_id, cast(p_partkey as varchar) as feature_id, 'S1' as sample_id, log2(p_size + 1.0) as value from part union all select 'C0', cast(p_partkey as varchar), 'S2', log2(p_retailprice + 1) from part
        union all select 'C2', cast(p_partkey as varchar), 'S1', p_size / 50.0 from part where (select count(*) from part) >= 1000 union all select 'C2', cast(p_partkey as varchar), 'S2', p_size / 100.0 from part where (select count(*) from part) >= 1000)
        select cohort_id, feature_id, sample_id, round(value, 4) as value from c""",
    "probe_to_gene_mean": _CELLS + " select cohort_id, p_brand as gene_key, sample_id, round(avg(value), 5) as value from cells join part on feature_id = cast(p_partkey as varchar) group by all",
    "probe_to_gene_join": _CELLS + " select cohort_id, feature_id, p_brand as gene_key, sample_id, round(value, 4) as value from cells join part on feature_id = cast(p_partkey as varchar)",
    "symbol_sum_collapse": _CELLS + " select cohort_id, p_brand as feature_id, sample_id, round(sum(value), 4) as value from cells join part on feature_id = cast(p_partkey as varchar) group by all",
    "tpm": _CELLS + """, rate as (select cohort_id, feature_id, sample_id, value / (p_size * 100 / 1000) as value from cells join part on feature_id = cast(p_partkey as varchar) where p_size > 0)
        select cohort_id, feature_id, sample_id, round(value / (sum(value) over (partition by cohort_id, sample_id) / 1e6), 3) as value from rate""",
    "renorm_1e6": _CELLS + " select cohort_id, feature_id, sample_id, round(value / sum(value) over (partition by cohort_id, sample_id) * 1e6, 3) as value from cells",
    "restrict_clean": _CELLS + " select cohort_id, feature_id, sample_id, round(value, 4) as value from cells where feature_id in (select cast(p_partkey as varchar) from part where p_size > 25)",
    "needs_log2": _CELLS + " select cohort_id, round(max(value), 4) as max_value, max(value) > 50 as needs_log2 from cells group by all",
    "integer_like": _CELLS + " select cohort_id, bool_and(abs(value - round(value)) <= 1e-6 + 1e-5 * abs(round(value))) as integer_like from cells group by all",
    "maybe_log2": _CELLS + " select cohort_id, feature_id, sample_id, round(case when needs_log2 then log2(value + 1) else value end, 4) as value from cells join flags using (cohort_id)",
    "to_linear": _CELLS + " select cohort_id, feature_id, sample_id, round(greatest(case when needs_log2 then value else pow(2, value) - 1 end, 0), 4) as value, not needs_log2 as was_log2 from cells join flags using (cohort_id)",
    "matrix_qc": _CELLS + """, f as (select cohort_id, max(value) as m, count(*) filter (where value < 0) as neg, count(distinct feature_id) as nf, count(distinct sample_id) as ns from cells group by all)
        select cohort_id, concat_ws('; ', case when m > 50 then 'linear-scale (max ' || printf('%.1f', m) || ')' end, case when neg > 0 then neg || ' negative values' end,
        case when nf >= 10 and ns > nf then 'more samples (' || ns || ') than features (' || nf || ')' end) as notes from f""",
    "low_feature_count": _CELLS + " select cohort_id, count(distinct feature_id) as n_features from cells where cohort_id <> '2' or cast(feature_id as int) % 3 = 0 group by all having count(distinct feature_id) < 1000",
    "normalize_matrix": _CELLS + """, o as (select cohort_id, count(distinct feature_id) >= 10 and count(distinct sample_id) > count(distinct feature_id) as turned from cells group by all)
        select cohort_id, case when turned then sample_id else feature_id end as feature_id, case when turned then feature_id else sample_id end as sample_id,
        round(case when needs_log2 then log2(value + 1) else value end, 4) as value from cells join flags using (cohort_id) join o using (cohort_id)""",
    "quantile_normalize": _CELLS.replace("avg(", "max(") + """, r as (select *, row_number() over (partition by cohort_id, sample_id order by value, feature_id) as k from cells), m as (select cohort_id, k, avg(value) as mean from r group by all)
        select cohort_id, feature_id, sample_id, round(mean, 6) as value from r join m using (cohort_id, k)""",
    "gene_frames_full_outer": """with g as (select l_linestatus, p_brand, case when p_size > 10 then p_type end as p_type, avg(l_quantity) as value from lineitem join part on l_partkey = p_partkey group by all),
        a as (select * from g where l_linestatus = 'O' and p_brand <> 'Brand#11'), b as (select * from g where l_linestatus = 'F' and p_brand <> 'Brand#12')
        select coalesce(a.p_brand, b.p_brand) as p_brand, coalesce(a.p_type, b.p_type) as p_type, round(a.value, 4) as left_value, round(b.value, 4) as right_value
        from a full outer join b on a.p_brand is not distinct from b.p_brand and a.p_type is not distinct from b.p_type""",
    "companion_coalesce": """with g as (select l_linestatus, l_partkey, l_suppkey, avg(l_quantity) as value from lineitem group by all)
        select l_partkey, l_suppkey, round(coalesce(max(value) filter (where l_linestatus = 'O'), max(value) filter (where l_linestatus = 'F')), 4) as value from g group by all""",
    "union_first_wins": "select p_partkey as probe_id, case when p_size <= 30 then p_brand else p_type end as gene_symbol from part where p_size is not null",
    "multi_platform_expression": _CELLS + """, m as (select cast(p_partkey as varchar) as feature_id, case when p_size <= 30 then p_brand else p_type end as gene from part),
        g as (select cohort_id, gene as feature_id, sample_id, avg(value) as value from cells join m using (feature_id) group by all)
        select cohort_id, feature_id, sample_id, round(case when max(value) over (partition by cohort_id) > 50 then log2(value + 1) else value end, 6) as value from g""",
    "reference_channel": """with c as (select cast(n_regionkey as varchar) as cohort_id, l_partkey, l_suppkey, avg(l_quantity) as q, avg(l_extendedprice) as p from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by all),
        v as (select cohort_id, l_partkey, var_samp(log2(greatest(q, 1))) as a, var_samp(log2(greatest(p, 1))) as b from c group by all), m as (select cohort_id, median(a) as a, median(b) as b from v group by all),
        k as (select *, case when greatest(a, b) > 0 and (greatest(a, b) - least(a, b)) / greatest(a, b) >= 0.1 then case when a <= b then 1 else 2 end end as r from m)
        select cohort_id, round(a, 5) as var1, round(b, 5) as var2, r as reference_channel, 3 - r as signal_channel, case when r is null then 'ambiguous' else 'variance' end as method from k""",
    "companion_pairing": _PAIRS + " select * from pairs",
    "pair_collapse": _PAIRS + """, rows as (select s_nationkey as cohort_id, 'A' || s_suppkey as sample_id, 'GPL96' as platform_id from supplier union all select s_nationkey, 'B' || s_suppkey, 'GPL97' from supplier where s_suppkey % 40 <> 7)
        select case when p.left_id is not null then r.sample_id || '+' || p.right_id else r.sample_id end as sample_id, case when p.left_id is not null then 'GPL96+GPL97' else r.platform_id end as platform_id, r.cohort_id
        from rows r left join pairs p on r.sample_id = p.left_id where r.sample_id not in (select right_id from pairs)""",
    "strategy_cascade": "with " + _RECORD.lstrip().removeprefix("with") + f""", o as (
        select platform_id, probe_id, 1 as k, 'direct_columns' as source, {_FIRST.format("gene_symbol")} as gene_symbol, {_FIRST.format("entrez_gene_id")} as entrez_id from platform_probe
        union all select p.platform_id, p.probe_id, 2, 'gene_assignment', f[2], list_filter(f, lambda x: regexp_full_match(x, '\\d+'))[-1] from parsed join platform_probe p using (row_id)),
        ok as (select * from o where gene_symbol is not null or entrez_id is not null), best as (select platform_id, min(k) as k from ok group by all)
        select platform_id, probe_id, gene_symbol, entrez_id, source from ok join best using (platform_id, k)""",
    "first_of_packed": f"select row_id, {_FIRST.format('gene_symbol')} as symbol, {_FIRST.format('entrez_gene_id')} as entrez_id from platform_probe",
    "packed_record_parse": "with " + _RECORD.lstrip() + " select row_id, f[2] as symbol, list_filter(f, lambda x: regexp_full_match(x, '\\d+'))[-1] as entrez_id from parsed",
    "identifier_type": """with i as (select p_brand as cohort_id, case when p_brand like '%1' then 'ENSG0000' || p_partkey when p_brand like '%2' then 'ENST0000' || p_partkey else p_name end as id from part),
        s as (select cohort_id, avg(case when regexp_matches(id, '^ENST\\d+$') then 1.0 else 0 end) as t, avg(case when regexp_matches(id, '^ENSG\\d+$') then 1.0 else 0 end) as g,
        avg(case when id in (select p_name from part where p_size > 30) then 1.0 else 0 end) as s from i group by all)
        select cohort_id, case when t >= 0.5 then 'transcript' when g >= 0.5 then 'gene' when s >= 0.2 then 'symbol' else 'unknown' end as id_type from s""",
    "strip_version": "select row_id, regexp_replace(gene_symbol, '\\.\\d+$', '') as symbol from platform_probe",
    "undouble_symbols": """with i as (select p_brand as cohort_id, p_partkey, p_type, p_partkey % 3 > 0 and p_brand like '%3' as doubled from part), g as (select cohort_id, avg(case when doubled then 1.0 else 0 end) > 0.5 as most from i group by all)
        select cohort_id, case when doubled and not most then p_type || '_' || p_type else p_type end as feature_id, p_partkey from i join g using (cohort_id)""",
    "gene_length_median": "select p_brand as gene_id, cast(round_even(median(p_size), 0) as bigint) as length from part where p_size > 5 group by all",
    "finalize_cells": _CELLS + _LINEAR + " select cohort_id, feature_id, sample_id, value from final",
    "finalize_report": _CELLS + _LINEAR + """, n as (select cohort_id, count(distinct feature_id) as nf, count(distinct sample_id) as ns from final group by all)
        select u.cohort_id, case when f.needs_log2 is null or u.unit is null then 'skipped' else 'processed' end as status,
        case when f.needs_log2 is null then 'no expression matrix' when u.unit is null then 'unit unknown' else '' end as reason, coalesce(nf, 0) as n_features, coalesce(ns, 0) as n_samples, not f.needs_log2 as was_log2
        from units u left join flags f using (cohort_id) left join n using (cohort_id)""",
}
