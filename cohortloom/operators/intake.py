"""Matrix files as submitters publish them made plain cells: which column is the identifier, which are no samples.

Tables are rows of cells, ``keys`` and (row_ord, cells), row 0 the header, as
``sources.tabular.read_rows`` gives them; one job covers all tables.  What is decided for a
table needs its header and one aggregate a column, so no table is held by one task.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import classify as C
from cohortloom.functions.clinical import column_key
from cohortloom.operators import matrix as M
from cohortloom.operators.identifiers import identifier_type, undoubled_ids
from cohortloom.operators.primary_file import primary_by_content, primary_by_name
from cohortloom.operators.report import ranked_first
from cohortloom.session import bounded, cut_lineage
from cohortloom.sources.tabular import MISSING

# Parts of the names of identifier columns, and whole names, in the order they are tried.
ID_PARTS = ["gene_symbol", "symbol", "gene_id", "geneid", "ensembl", "probe_id", "probeid", "id_ref"]
ID_NAMES = ["gene", "id", "name"]
# Parts of the names of columns that hold no sample, and whole names.
METADATA_PARTS = [
    *ID_PARTS, "entrez", "seqnames", "chr", "chromosome", "strand", "start", "end", "width", "biotype", "type_of_gene", "locus", "hgnc", "name", "length", "description", "annotation",
    "fold_change", "foldchange", "log2fc", "logfc", "p_value", "pvalue", "padj", "fdr", "q_value", "qvalue",
]
METADATA_NAMES = ["#", "index", "no", "no.", "rownum", "row_number", "row_num"]
#: A transcriptome has so many genes at least.
LEAST_GENES = 16_000
# The identifier types, the most wanted first.
ID_TYPES = ["transcript", "gene", "symbol"]


def identifier_place(names: Column) -> Column:
    """The place (from 1) of the identifier among column names: by a part of its name, then by its whole name, else the first."""
    normal = F.transform(names, column_key)
    with_part = [F.nullif(F.array_position(F.transform(normal, lambda n: n.contains(w)), F.lit(True)), F.lit(0)) for w in ID_PARTS]  # noqa: B023 - used at once
    with_name = [F.nullif(F.array_position(normal, F.lit(w)), F.lit(0)) for w in ID_NAMES]
    return F.coalesce(*with_part, *with_name, F.lit(1)).cast("int")


def named_as_metadata(name: Column) -> Column:
    """Whether a column's name tells that it holds no sample."""
    normal = column_key(name)
    return reduce(or_, [normal.contains(w) for w in METADATA_PARTS]) | normal.isin(METADATA_NAMES)


def _number(text: Column) -> Column:
    return F.when(~text.isin(MISSING), text.try_cast("double"))


def with_headers(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, names, recovered, n_rows): the header of each table; where all rows have one cell more, the unnamed first column is named gene_id."""
    facts = rows.where("cells is not null").groupBy(*keys).agg(
        F.max(F.when(F.col("row_ord") == 0, F.col("cells"))).alias("names"),
        F.min(F.when(F.col("row_ord") > 0, F.size("cells"))).alias("least"),
        F.max(F.when(F.col("row_ord") > 0, F.size("cells"))).alias("most"),
        F.count_if(F.col("row_ord") > 0).alias("n_rows"),
    )
    recovered = F.coalesce((F.col("least") == F.col("most")) & (F.col("least") == F.size("names") + 1), F.lit(False))
    return facts.where("names is not null").select(*keys, F.when(recovered, F.concat(F.array(F.lit("gene_id")), "names")).otherwise(F.col("names")).alias("names"), recovered.alias("recovered"), "n_rows")


def column_facts(rows: DataFrame, headers: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, place, name, is_numeric) of every column; a column is numeric if all its values are numbers or missing."""
    cells = rows.where("row_ord > 0 and cells is not null").select(*keys, F.posexplode("cells").alias("place", "cell"))
    text = cells.groupBy(*keys, (F.col("place") + 1).alias("place")).agg(F.max((_number(F.col("cell")).isNull() & ~F.col("cell").isin(MISSING)).cast("int")).alias("text"))
    named = headers.select(*keys, F.posexplode("names").alias("place", "name")).withColumn("place", F.col("place") + 1)
    return named.join(text, [*keys, "place"], "left").select(*keys, "place", "name", (F.coalesce("text", F.lit(0)) == 0).alias("is_numeric"))


def intake_plan(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, id_place, id_column, samples, dropped, status, notes, n_rows): what of each table is its matrix.

    samples are the places of the sample columns; status is ``ok`` or ``refused``: where what is
    left looks like fewer than two samples of many columns, the file was misread (as one
    with two header rows) and is left as it is.
    """
    headers = bounded(with_headers(rows, keys))
    facts = column_facts(rows, headers, keys).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("place", "name", "is_numeric"))).alias("columns"))
    planned = facts.join(headers.select(*keys, "names", "recovered", "n_rows"), keys).withColumn("id_place", identifier_place(F.col("names")))
    extra = F.filter("columns", lambda c: (c["place"] != F.col("id_place")) & (~c["is_numeric"] | named_as_metadata(c["name"])))
    planned = planned.withColumn("extra", extra).withColumn("rest", F.filter("columns", lambda c: (c["place"] != F.col("id_place")) & ~F.exists(F.col("extra"), lambda e: e["place"] == c["place"])))
    refused = (F.size("extra") > 0) & (F.size("columns") > 3) & (F.size("rest") < 2)
    dropped = F.transform("extra", lambda c: c["name"])
    notes = F.concat_ws(
        "; ",
        F.when(F.col("recovered"), "the identifier had no column name"),
        F.when(refused, F.concat(F.size("extra").cast("string"), F.lit(" of "), (F.size("columns") - 1).cast("string"), F.lit(" columns look like metadata, which leaves fewer than 2 samples; left unchanged"))).when(
            F.size("extra") > 0, F.concat(F.lit("dropped "), F.size("extra").cast("string"), F.lit(" columns without samples: "), F.array_join(dropped, ", "))
        ),
    )
    return planned.select(
        *keys, "id_place", F.element_at("names", F.col("id_place")).alias("id_column"), F.transform("rest", lambda c: F.struct(c["place"].alias("place"), c["name"].alias("name"))).alias("samples"),
        F.when(refused, F.array().cast("array<string>")).otherwise(dropped).alias("dropped"), F.when(refused, "refused").otherwise("ok").alias("status"), notes.alias("notes"), "n_rows",
    )


def intake_cells(rows: DataFrame, plan: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, feature_id, sample_id, value): the cells of the sample columns of each table that isn't refused; missing texts are null."""
    wanted = bounded(plan.where("status = 'ok'").select(*keys, "id_place", "samples"))
    body = rows.where("row_ord > 0 and cells is not null").join(wanted, keys)
    pairs = F.transform("samples", lambda s: F.struct(s["name"].alias("sample_id"), F.try_element_at(F.col("cells"), s["place"]).alias("cell")))
    long = body.select(*keys, F.try_element_at("cells", F.col("id_place")).alias("feature_id"), F.explode(pairs).alias("c"))
    return M.clean_cells(long.select(*keys, "feature_id", "c.sample_id", _number(F.col("c.cell")).alias("value")))


def identifier_axes(rows: DataFrame, symbols: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, place, name, id_type): the column whose values are known identifiers; transcripts before genes before symbols, then the first.

    All values of all text columns are judged, doubled symbols undone where most are; tables
    without a recognizable column have no row.
    """
    headers = bounded(with_headers(rows, keys))
    facts = cut_lineage(column_facts(rows, headers, keys).where("not is_numeric").withColumn("cohort_id", F.to_json(F.struct(*keys, "place"))))
    cells = rows.where("row_ord > 0 and cells is not null").select(*keys, F.posexplode("cells").alias("place", "feature_id")).withColumn("place", F.col("place") + 1)
    ids = cells.join(facts.select(*keys, "place", "cohort_id"), [*keys, "place"]).select("cohort_id", "feature_id")
    kinds = identifier_type(undoubled_ids(ids), symbols).where("id_type <> 'unknown'")
    found = facts.join(kinds, "cohort_id").select(*keys, "place", "name", "id_type")
    return ranked_first(found, keys, [F.array_position(F.array(*[F.lit(t) for t in ID_TYPES]), F.col("id_type")), F.col("place")])


def primary_matrices(rows: DataFrame, samples: DataFrame, cohort: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(report, cells) of the primary matrix of each cohort among its files and the members of its archives.

    ``rows`` as from ``read_rows`` (written before, as they are read several times), ``samples``
    (cohort_id, n_samples); a file's cohort is the folder it lies in unless told.  A file is
    picked by the unit in its name, else the one plain file whose columns fit the number of
    samples.  report: cohort_id, path, member, unit, status (ok, refused, unreadable, multi_part,
    none), truncated, notes.  cells: the picked matrices, turned and scaled as ``normalized`` does.
    """
    cohort = F.element_at(F.split("path", "/"), -2) if cohort is None else cohort
    rows = rows.withColumn("cohort_id", cohort)
    keys = ["cohort_id", "path", "member"]
    name = F.element_at(F.split(F.when(F.col("member") == "", F.col("path")).otherwise(F.col("member")), "/"), -1)
    headers = with_headers(rows, keys)
    tables = cut_lineage(
        rows.groupBy(*keys).agg(F.max("error").alias("error")).withColumn("name", name).withColumn("ord", F.struct("path", "member")).join(headers, keys, "left").select(*keys, "name", "ord", "error", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("names", F.array().cast("array<string>")).alias("columns"))
    )
    named = primary_by_name(tables.drop("ord").withColumn("ord", F.to_json(F.struct("path", "member"))))
    unnamed = tables.join(named.select("cohort_id"), "cohort_id", "left_anti").where("member = ''")
    judged = primary_by_content(unnamed, samples)
    picks = named.select("cohort_id", "name", "unit").unionByName(judged.where("verdict = 'single'").select("cohort_id", F.col("names").alias("name"), F.lit("unknown").alias("unit")))
    chosen = ranked_first(tables.join(picks, ["cohort_id", "name"]), ["cohort_id"], [F.col("path"), F.col("member")])
    chosen = cut_lineage(chosen.select(*keys, "unit", "error"))
    own = rows.join(bounded(chosen.select(*keys)), keys, "left_semi")
    plan = cut_lineage(intake_plan(own, keys))
    cells = intake_cells(own, plan, keys).select("cohort_id", "feature_id", "sample_id", "value")
    cells = cut_lineage(cells)
    final = M.normalized(cells)
    genes = final.groupBy("cohort_id").agg(F.count_distinct("feature_id").alias("n_genes"))
    parts = judged.where("verdict = 'multi_part'").select("cohort_id", F.concat(F.lit("no single matrix; together these files have the columns of all samples: "), F.col("names")).alias("parts"))
    report = tables.select("cohort_id").distinct().join(chosen, "cohort_id", "left").join(plan.select("cohort_id", F.col("status").alias("plan_status"), F.col("notes").alias("plan_notes")), "cohort_id", "left")
    report = report.join(genes, "cohort_id", "left").join(M.matrix_qc(cells).withColumnRenamed("notes", "qc"), "cohort_id", "left").join(parts, "cohort_id", "left")
    truncated = F.coalesce(F.col("n_genes") < LEAST_GENES, F.lit(False))
    status = F.when(F.col("parts").isNotNull(), "multi_part").when(F.col("path").isNull(), "none").otherwise(F.coalesce("plan_status", F.lit("unreadable")))
    few = F.when(truncated, F.concat(F.lit("only "), F.col("n_genes").cast("string"), F.lit(" genes, likely a filtered list")))
    notes = F.concat_ws("; ", F.nullif("plan_notes", F.lit("")), F.nullif("qc", F.lit("")), few, "parts", F.when(F.col("error").isNotNull(), F.concat(F.lit("can't be read: "), F.col("error"))))
    return report.select("cohort_id", "path", "member", "unit", status.alias("status"), truncated.alias("truncated"), notes.alias("notes")), final


def output_name(name: Column) -> Column:
    """A file name as the packed tab-separated table it becomes: known endings of tables and packing replaced."""
    return F.concat(F.regexp_replace(name, r"(?i)(?:\.(?:txt|tsv|csv|xlsx|xls|tab))?(?:\.gz)?$", ""), F.lit(".tsv.gz"))


def needs_conversion(name: Column) -> Column:
    """Whether a table isn't tab-separated text already, by its ending."""
    return C.data_file(name) & ~F.regexp_replace(F.lower(name), r"\.gz$", "").rlike(r"\.(?:txt|tsv)$")
