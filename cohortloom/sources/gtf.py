"""Gene annotation in GTF text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def attribute(attributes: Column, name: str) -> Column:
    """All values of one attribute, comma-joined; null without one."""
    found = F.regexp_extract_all(attributes, F.lit(rf'(?:^|;\s*){name} "?([^";]*)"?'))
    return F.when(F.size(found) > 0, F.array_join(found, ","))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, feature, start, end, strand, attributes) of gene, transcript and exon lines; comments left out."""
    parts = F.split("value", "\t")
    lines = spark.read.text(path).where(~F.col("value").startswith("#")).select(parts.alias("p")).where("size(p) >= 9")
    return lines.select(
        F.col("p")[0].alias("chrom"), F.col("p")[2].alias("feature"), F.col("p")[3].try_cast("long").alias("start"), F.col("p")[4].try_cast("long").alias("end"), F.col("p")[6].alias("strand"), F.col("p")[8].alias("attributes")
    ).where("feature in ('gene', 'transcript', 'exon')")


def genes(lines: DataFrame) -> DataFrame:
    """(gene_id, gene_symbol, gene_type, gene_tags, chrom), without the copies on Y of genes shared with X."""
    a = F.col("attributes")
    rows = lines.where("feature = 'gene'").select(attribute(a, "gene_id").alias("gene_id"), attribute(a, "gene_name").alias("gene_symbol"), attribute(a, "gene_type").alias("gene_type"), attribute(a, "tag").alias("gene_tags"), "chrom")
    on_x = rows.where("chrom = 'chrX'").select("gene_symbol").distinct()
    shared = rows.where("chrom = 'chrY'").join(on_x, "gene_symbol", "left_semi").select("gene_id")
    return rows.where(~F.col("gene_id").endswith("_PAR_Y")).join(shared, "gene_id", "left_anti")


def transcripts(lines: DataFrame) -> DataFrame:
    """(transcript_id, gene_id, gene_symbol, gene_type, transcript_type, ccdsid, transcript_length, chrom): length is the sum of the exons."""
    a = F.col("attributes")
    exons = lines.where("feature = 'exon'").groupBy(attribute(a, "transcript_id").alias("transcript_id")).agg(F.sum(F.col("end") - F.col("start") + 1).alias("transcript_length"))
    rows = lines.where("feature = 'transcript'").select(
        *[attribute(a, k).alias(n) for k, n in (("transcript_id", "transcript_id"), ("gene_id", "gene_id"), ("gene_name", "gene_symbol"), ("gene_type", "gene_type"), ("transcript_type", "transcript_type"))], F.coalesce(attribute(a, "ccdsid"), F.lit("")).alias("ccdsid"), "chrom"
    )
    return rows.where(~F.col("gene_id").endswith("_PAR_Y")).join(exons, "transcript_id", "left")
