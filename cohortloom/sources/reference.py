"""Gene reference tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions.identifiers import strip_version
from cohortloom.operators.identifiers import gene_lengths


class GeneReference(NamedTuple):
    """Symbols of transcripts and genes, gene lengths, and all known symbols."""

    transcript_symbols: DataFrame
    gene_symbols: DataFrame
    lengths: DataFrame
    known_symbols: DataFrame


def _tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True)


def gene_reference(genes: DataFrame, transcripts: DataFrame, clean: DataFrame | None = None) -> GeneReference:
    """The reference of (ID, Gene), (transcript_id, gene_id, gene_symbol, transcript_length, included) and the clean transcripts where there are any.

    Ids are without version; of several symbols of an id the least counts.
    """
    source = clean if clean is not None else transcripts
    of = lambda df, i, s: df.where(F.col(s).isNotNull()).groupBy(strip_version(F.col(i)).alias("feature_id")).agg(F.min(s).alias("symbol"))
    by_transcript, by_gene = of(source, "transcript_id", "gene_symbol"), of(genes, "ID", "Gene")
    lengths = gene_lengths(transcripts.withColumn("included", F.lower(F.col("included").cast("string")) == "true").withColumn("transcript_length", F.col("transcript_length").cast("string").try_cast("long")))
    return GeneReference(by_transcript, by_gene, lengths, by_transcript.select("symbol").union(by_gene.select("symbol")).distinct())


def read_gene_reference(spark: SparkSession, genes: str, transcripts: str, clean: str | None = None) -> GeneReference:
    """``gene_reference`` of tab-separated files, packed or not."""
    return gene_reference(_tsv(spark, genes), _tsv(spark, transcripts), _tsv(spark, clean) if clean else None)


def clean_symbols(spark: SparkSession, path: str) -> DataFrame:
    """(feature_id): the distinct symbols of a clean gene list."""
    return _tsv(spark, path).select(F.col("gene_symbol").alias("feature_id")).where("feature_id is not null").distinct()
