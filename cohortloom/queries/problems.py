"""Queries of the data-processing problems in the core, over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.drift import schema_changes
from cohortloom.operators.drift_table import unified_samples
from cohortloom.operators.heavy_keys import heavy_keys, per_key_summary
from cohortloom.operators.orphans import change_stream, orphans_of, reference_counts
from cohortloom.operators.packed import split_packed
from cohortloom.operators.units import numeric_column_days as column_days
from cohortloom.operators.units import times_in_days
from cohortloom.session import load


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Cohorts and platforms with at least 3 % of all annotation rows."""
    return heavy_keys(load(spark, d, "annotation"), ["gse_id", "platform_id"])


def p1_summary(spark: SparkSession, d: str) -> DataFrame:
    """Rows, samples, re-deliveries, ages and times of every cohort and platform."""
    out = per_key_summary(load(spark, d, "annotation"), ["gse_id", "platform_id"])
    return out.withColumn("mean_age", F.round("mean_age", 6))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose reference has no target in force at their own time."""
    stream = change_stream(load(spark, d, "annotation"), references={"annotation": "gse_id"}, targets={"sample_id_map": "gsm_id"})
    stream = stream.unionByName(change_stream(load(spark, d, "series"), targets={"annotation": "gse_id"}))
    return orphans_of(stream.unionByName(change_stream(load(spark, d, "sample_id_map"), references={"sample_id_map": "gsm_id"})))


def p2_by_month(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references by table, month and kind."""
    return p2_found(spark, d).groupBy("src_table", "load_month", "orphan_kind").agg(F.count(F.lit(1)).alias("n_rows"))


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    """Keys that are referred to and don't exist after all changes, with their signed counts."""
    annotation = load(spark, d, "annotation")
    one = reference_counts(annotation, "gse_id", load(spark, d, "series"), "gse_id").withColumn("src_table", F.lit("annotation"))
    two = reference_counts(load(spark, d, "sample_id_map"), "gsm_id", annotation, "gsm_id").withColumn("src_table", F.lit("sample_id_map"))
    return one.unionByName(two).where("n_alive = 0")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Every change of a cohort file's fields against the release before."""
    return schema_changes(load(spark, d, "cohort_record"), load(spark, d, "column_cluster"))


def p3_samples(spark: SparkSession, d: str) -> DataFrame:
    """One consistent table of sample values out of all cohort files."""
    return unified_samples(load(spark, d, "cohort_record"), load(spark, d, "column_cluster"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Each real value of the packed probe cells with its place."""
    return split_packed(load(spark, d, "platform_probe"), ["gene_symbol", "entrez_gene_id", "gene_assignment"], nested=("gene_assignment",))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Follow-up times in whole days."""
    return times_in_days(load(spark, d, "followup"), load(spark, d, "survival_mapping"), load(spark, d, "numeric_column_unit"))


def numeric_column_days(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of columns with a plain unit in days, under a derived name, beside the raw value."""
    days = column_days(load(spark, d, "followup"), load(spark, d, "numeric_column_unit"))
    return days.select("row_id", "raw_time", "derived_name", F.round("days", 6).alias("days"))


QUERIES = {f.__name__: f for f in (p1_found, p1_summary, p2_found, p2_by_month, p2_counts, p3_found, p3_samples, p5_found, p6_found, numeric_column_days)}

_KEY = "nullif(nullif(nullif(upper(trim({0}, E' \\t\\n\\r')), ''), '---'), 'NONE')"
_ANNOTATION_KEYS = f"""
select 'gse_id' as key_field, {_KEY.format("gse_id")} as key_text, {_KEY.format("gsm_id")} as item, age, epoch_us(loaded_at) as at_us from annotation
union all
select 'platform_id', {_KEY.format("platform_id")}, {_KEY.format("gsm_id")}, age, epoch_us(loaded_at) from annotation"""
_FOUND2 = f"""
with refs as (
  select 'annotation' as src_table, row_id, {_KEY.format("gse_id")} as k, loaded_at from annotation
  union all select 'sample_id_map', row_id, {_KEY.format("gsm_id")}, loaded_at from sample_id_map),
targets as (
  select 'annotation' as src_table, {_KEY.format("gse_id")} as k, loaded_at as since, removed_at as until from series
  union all select 'sample_id_map', {_KEY.format("gsm_id")}, loaded_at, removed_at from annotation),
judged as (
  select r.src_table, r.row_id, r.loaded_at, count(t.k) as n, min(t.since) as first,
         count(*) filter (where t.since <= r.loaded_at and (t.until is null or t.until > r.loaded_at)) as alive
  from refs r left join targets t on r.src_table = t.src_table and r.k = t.k
  where r.k is not null group by r.src_table, r.row_id, r.loaded_at),
found as (
  select src_table, row_id, strftime(loaded_at, '%Y-%m') as load_month,
         case when n = 0 then 'missing' when first > loaded_at then 'late' else 'deleted' end as orphan_kind
  from judged where alive = 0)
"""
_WORDS = {1.0: "days?|dys|dy|d", 7.0: "weeks?|wks?|w", 30.4375: "months?|mths?|mos|mo|m", 365.25: "years?|yrs?|y"}


def _unit_in(text: str, letters: str) -> str:
    """The size of the first kind of unit that a text holds as a word, in SQL."""
    return "case " + " ".join(f"when regexp_matches({text}, '(^|[^{letters}])({w})([^{letters}]|$)') then {size}::double" for size, w in _WORDS.items()) + " end"


_FOUND6 = f"""
with r as (select row_id, {_KEY.format("gse_id")} as k, column_name as c, lower(trim(raw_time, E' \\t\\n\\r')) as t from followup where {_KEY.format("raw_time")} is not null),
p as (select *, list_transform(regexp_extract_all(t, '[0-9]+(?:[.,][0-9]+)*'), lambda x: try_cast(replace(regexp_replace(x, ',([0-9][0-9][0-9])($|[^0-9])', '\\1\\2', 'g'), ',', '.') as double)) as n,
         list_position(['one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine', 'ten', 'eleven', 'twelve'], split_part(t, ' ', 1)) as word, {_unit_in("t", "a-z")} as unit from r),
u as (select {_KEY.format("gse_id")} as k, time_column as c, lower(trim(time_unit)) as u, 0 as rank from survival_mapping union all select {_KEY.format("gse_id")}, column_name, lower(trim(unit)), 1 from numeric_column_unit),
s as (select k, c, rank, size, count(*) as m from (select k, c, rank, {_unit_in("u", "a-z")} as size from u) where size is not null and k is not null and c is not null group by all),
told as (select k, c, size, row_number() over (partition by k, c order by rank, m desc, size desc) as place from s),
d as (
  select row_id, case when len(n) = 2 and regexp_matches(t, '(years?|yrs?|y)[^a-z]') and regexp_matches(t, '(months?|mths?|mos?|m)$') then n[1] * 365.25 + n[2] * 30.4375
         when len(n) = 1 then n[1] * coalesce(unit, size, {_unit_in("lower(p.c)", "a-z0-9")}) when len(n) = 0 and word is not null then word * unit end as days
  from p left join told on p.k = told.k and p.c = told.c and place = 1)
select row_id, cast(floor(round(days, 6) + 0.5) as bigint) as time_days from d where days is not null"""
# Quoted parts are set aside as chr(1), slots are cut at chr(2) and pieces at chr(3), then the quoted parts come back by their number.
_FOUND5 = r"""
with c as (
  select row_id, 'gene_symbol' as src_field, trim(gene_symbol, ' ') as cell from platform_probe union all select row_id, 'entrez_gene_id', trim(entrez_gene_id, ' ') from platform_probe
  union all select row_id, 'gene_assignment', trim(gene_assignment, ' ') from platform_probe),
m as (
  select row_id, src_field, regexp_extract_all(cell, '"(?:[^"]|"")*"|''[^'']*''') as q, array_to_string(regexp_split_to_array(cell, '"(?:[^"]|"")*"|''[^'']*'''), chr(1)) as t from c where cell is not null),
s as (
  select *, case when src_field = 'gene_assignment' then regexp_replace(regexp_replace(t, '(\r?\n)?[ \t]*///[ ]*(\r?\n)?|\r?\n', chr(2), 'g'), '//|\t|\|', chr(3), 'g')
                 else regexp_replace(t, '///|//| / |^/ | /$|[;,|\t\n]', chr(2), 'g') end as cut from m),
slots as (select row_id, src_field, q, string_split(cut, chr(2)) as a from s),
placed as (select row_id, src_field, q, unnest(a) as slot, generate_subscripts(a, 1) as slot_no, a from slots),
pieces as (
  select row_id, src_field, q, slot_no, string_split(slot, chr(3)) as b, length(regexp_replace(array_to_string(a[1:slot_no - 1], ''), '[^\x01]', '', 'g')) as before from placed),
items as (select row_id, src_field, q, slot_no, generate_subscripts(b, 1) as piece_no, unnest(b) as item, b, before from pieces),
told as (
  select row_id, src_field, slot_no, piece_no, case when contains(item, chr(1)) then q[before + length(regexp_replace(array_to_string(b[1:piece_no - 1], ''), '[^\x01]', '', 'g')) + 1] end as quoted, trim(item, E' \t\r\n') as item from items),
final as (select row_id, src_field, slot_no, piece_no, case when quoted is null then item else trim(replace(quoted[2:-2], repeat(quoted[1], 2), quoted[1])) end as item from told)
select row_id, src_field, cast(slot_no as int) as slot_no, cast(piece_no as int) as piece_no, item from final where upper(item) not in ('---', '', 'NONE')"""
SQL = {
    "p5_found": _FOUND5,
    "p6_found": _FOUND6,
    "numeric_column_days": """
with u as (select gse_id, column_name, min(unit) as unit from numeric_column_unit where unit in ('days', 'months', 'years') group by all)
select f.row_id, f.raw_time, 'llm_' || lower(regexp_replace(regexp_replace(f.column_name, '[^0-9A-Za-z]+', '_', 'g'), '^_+|_+$', '', 'g')) || '_days' as derived_name,
       round(coalesce(try_cast(f.raw_time as double), try_cast(nullif(regexp_extract(f.raw_time, '(-?[0-9]+[.]?[0-9]*)', 1), '') as double))
             * case u.unit when 'days' then 1.0::double when 'months' then 30.4375::double else 365.25::double end, 6) as days
from followup f join u on f.gse_id = u.gse_id and f.column_name = u.column_name""",
    "p1_found": f"""
with k as ({_ANNOTATION_KEYS})
select key_field, key_text from k where key_text is not null
group by key_field, key_text having count(*) >= 0.03 * (select count(*) from annotation)""",
    "p1_summary": f"""
with k as ({_ANNOTATION_KEYS}),
g as (select *, at_us - lag(at_us) over (partition by key_field, key_text, item order by at_us) as gap from k where key_text is not null)
select key_field, key_text, count(*) as n_rows, count(distinct item) as n_samples, count(item) - count(distinct item) as n_redelivered,
       round(avg(age), 6) as mean_age, min(at_us) as first_us, max(at_us) as last_us, max(case when item is not null then gap end) as widest_gap_us
from g group by key_field, key_text""",
    "p2_found": _FOUND2 + "select * from found",
    "p2_by_month": _FOUND2 + "select src_table, load_month, orphan_kind, count(*) as n_rows from found group by all",
    "p2_counts": f"""
with refs as (
  select 'annotation' as src_table, {_KEY.format("gse_id")} as ref_key, case when removed_at is null then 1 else 0 end as r from annotation
  union all select 'sample_id_map', {_KEY.format("gsm_id")}, 1 from sample_id_map),
targets as (
  select 'annotation' as src_table, {_KEY.format("gse_id")} as ref_key, case when removed_at is null then 1 else 0 end as a from series
  union all select 'sample_id_map', {_KEY.format("gsm_id")}, case when removed_at is null then 1 else 0 end from annotation),
n as (select src_table, ref_key, cast(sum(r) as bigint) as n_refs from refs where ref_key is not null group by all),
m as (select src_table, ref_key, cast(sum(a) as bigint) as n_alive from targets group by all)
select n.ref_key, n.n_refs, coalesce(m.n_alive, 0) as n_alive, n.src_table
from n left join m on n.src_table = m.src_table and n.ref_key = m.ref_key where n.n_refs > 0 and coalesce(m.n_alive, 0) = 0""",
}
