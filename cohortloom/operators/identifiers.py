"""Decisions on identifier columns of a whole cohort or platform."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.identifiers import (
    CANONICAL_SYMBOLS,
    CLONE_PLACEHOLDER,
    GENE_ID,
    MIN_CANONICAL,
    MIN_ID_SHARE,
    MIN_SYMBOL_SHARE,
    MIN_UNWRAP_SHARE,
    TRANSCRIPT_ID,
    assigned_entrez,
    assigned_symbol,
    canonical_id,
    embedded_id,
    first_of_packed,
    strip_version,
    undoubled,
)


def identifier_type(ids: DataFrame, symbols: DataFrame) -> DataFrame:
    """(cohort_id, id_type): transcript, gene, symbol or unknown, over all ids of a cohort.

    ``symbols`` (symbol) are the known ones.  Ids are unwrapped before the test.
    """
    known = symbols.select(F.col("symbol").alias("id")).where("id is not null").distinct().withColumn("known", F.lit(1.0))
    clean = ids.select("cohort_id", canonical_id(F.col("feature_id")).alias("id")).join(known, "id", "left")
    share = clean.groupBy("cohort_id").agg(
        F.coalesce(F.avg(F.col("id").rlike(TRANSCRIPT_ID).cast("double")), F.lit(0.0)).alias("t"),
        F.coalesce(F.avg(F.col("id").rlike(GENE_ID).cast("double")), F.lit(0.0)).alias("g"),
        F.avg(F.coalesce("known", F.lit(0.0))).alias("s"),
    )
    kind = F.when(F.col("t") >= MIN_ID_SHARE, "transcript").when(F.col("g") >= MIN_ID_SHARE, "gene").when(F.col("s") >= MIN_SYMBOL_SHARE, "symbol").otherwise("unknown")
    return share.select("cohort_id", kind.alias("id_type"))


def _unwrapped(ids: DataFrame, rule) -> DataFrame:
    taken = ids.withColumn("taken", rule(F.col("feature_id")))
    gate = taken.groupBy("cohort_id").agg((F.avg(F.col("taken").isNotNull().cast("double")) > MIN_UNWRAP_SHARE).alias("most"))
    return taken.join(gate, "cohort_id").withColumn("feature_id", F.when(F.col("most"), F.coalesce("taken", "feature_id")).otherwise(F.col("feature_id"))).drop("taken", "most")


def undoubled_ids(ids: DataFrame) -> DataFrame:
    """Doubled symbols undone where most ids of the cohort are doubled."""
    return _unwrapped(ids, undoubled)


def unwrapped_ids(ids: DataFrame) -> DataFrame:
    """Embedded Ensembl ids taken out where most ids of the cohort hold one."""
    return _unwrapped(ids, embedded_id)


def probe_gene_map(probes: DataFrame) -> DataFrame:
    """(platform_id, probe_id, gene_symbol, entrez_id, source) by the first strategy that gives a platform any row.

    ``probes`` has platform_id, probe_id and any of gene_symbol, entrez_gene_id,
    gene_assignment, ORF, PrimarySequenceName.  The order is direct columns, packed
    assignment, all-Ensembl ORF, sequence name without clone placeholders, and probe
    ids that are symbols themselves; probes of a platform with none stay unmapped.
    """
    col = lambda name: F.col(name).cast("string") if name in probes.columns else F.lit(None).cast("string")
    symbol, entrez = first_of_packed(col("gene_symbol")), first_of_packed(col("entrez_gene_id"))
    orf, seq = col("ORF"), first_of_packed(col("PrimarySequenceName"))
    platform = probes.groupBy("platform_id").agg(
        F.coalesce(F.bool_and(orf.rlike(GENE_ID)), F.lit(False)).alias("orf_ok"), (F.count_if(F.col("probe_id").cast("string").isin(CANONICAL_SYMBOLS)) >= MIN_CANONICAL).alias("ids_ok")
    )
    none = F.lit(None).cast("string")
    made = lambda rank, source, s, e, ok: F.when(ok, F.struct(F.lit(rank).alias("rank"), F.lit(source).alias("source"), s.alias("gene_symbol"), e.alias("entrez_id")))
    options = F.array_compact(F.array(
        made(1, "direct_columns", symbol, entrez, symbol.isNotNull() | entrez.isNotNull()),
        made(2, "gene_assignment", assigned_symbol(col("gene_assignment")), assigned_entrez(col("gene_assignment")), assigned_symbol(col("gene_assignment")).isNotNull()),
        made(3, "ensembl_orf", first_of_packed(orf), none, F.col("orf_ok") & first_of_packed(orf).isNotNull()),
        made(4, "primary_sequence_name", seq, none, seq.isNotNull() & ~seq.rlike(CLONE_PLACEHOLDER)),
        made(5, "probe_id_is_symbol", F.col("probe_id").cast("string"), none, F.col("ids_ok") & F.col("probe_id").isNotNull()),
    ))
    found = probes.join(platform, "platform_id").select("platform_id", F.col("probe_id").cast("string").alias("probe_id"), F.explode(options).alias("o")).select("platform_id", "probe_id", "o.*")
    best = found.groupBy("platform_id").agg(F.min("rank").alias("rank"))
    return found.join(best, ["platform_id", "rank"]).select("platform_id", "probe_id", "gene_symbol", "entrez_id", "source")


def gene_lengths(transcripts: DataFrame) -> DataFrame:
    """(gene_id, length): the rounded median (half to even) of the included transcripts' lengths."""
    return transcripts.where("included").groupBy(strip_version(F.col("gene_id")).alias("gene_id")).agg(F.bround(F.median("transcript_length")).cast("long").alias("length"))
