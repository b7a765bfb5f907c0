"""Queries of the clinical-text problems, over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.mapping import map_values
from cohortloom.llm.packing import pack_documents
from cohortloom.llm.surrogates import entity_places, with_placeholders, with_surrogates
from cohortloom.llm.tokens import decoded_texts, token_ids
from cohortloom.session import load


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The canonical entry of every typed value and diagnosis, 0 if none is meant."""
    entries = load(spark, d, "value_mapping_entry").select(F.lit("value_mapping_entry").alias("src_table"), "row_id", "concept", F.col("raw_value").alias("value"))
    groups = load(spark, d, "sample_group").select(F.lit("sample_group").alias("src_table"), "row_id", F.lit("diagnosis").alias("concept"), F.col("diagnosis").alias("value"))
    return map_values(entries.unionByName(groups), load(spark, d, "canonical_value"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids of every document by byte_bpe_50k."""
    return token_ids(load(spark, d, "documents"))


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its container of 2,048 tokens."""
    return pack_documents(load(spark, d, "documents"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """Each container with its items and the space used."""
    return p8_packed(spark, d).groupBy("container_id").agg(F.count(F.lit(1)).alias("n_items"), F.sum("n_tokens").alias("n_used"))


def p7_texts(spark: SparkSession, d: str) -> DataFrame:
    """Every document's text back from its ids."""
    return decoded_texts(p7_ids(spark, d)).select("doc_id", "text")


def p8_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of a packing: the documents in it, and how many containers or documents break a rule.

    n_over: containers above 2,048 tokens; n_gaps: documents whose pieces don't follow each
    other from their first token on; n_needless: documents of at most 2,048 tokens in several pieces.
    """
    packed = p8_packed(spark, d)
    over = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("used")).agg(F.count_if(F.col("used") > 2048).alias("n_over"))
    whole = packed.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.max("token_to").alias("last"), F.min("token_from").alias("first"), F.count(F.lit(1)).alias("k"), F.count_distinct("piece_no").alias("pieces"))
    gaps = (F.col("first") > 0) | (F.col("n") != F.col("last")) | (F.col("k") != F.col("pieces"))
    docs = whole.agg(F.count(F.lit(1)).alias("n_documents"), F.count_if(gaps).alias("n_gaps"), F.count_if((F.col("n") <= 2048) & (F.col("k") > 1)).alias("n_needless"))
    return docs.withColumn("n_over", over.select("n_over").scalar())


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Every mention of personal information with its kind and place."""
    return entity_places(load(spark, d, "documents"))


#: The secret of the example queries; a deployment passes its own.
EXAMPLE_KEY = "example key"


def p9_text(spark: SparkSession, d: str) -> DataFrame:
    """All texts with typed placeholders."""
    return with_placeholders(load(spark, d, "documents"), EXAMPLE_KEY)


def p9_surrogates(spark: SparkSession, d: str) -> DataFrame:
    """All texts with keyed surrogates in the place of personal information."""
    return with_surrogates(load(spark, d, "documents"), EXAMPLE_KEY)


QUERIES = {f.__name__: f for f in (p4_found, p7_ids, p7_texts, p8_packed, p8_containers, p8_invariants, p9_found, p9_text, p9_surrogates)}
SQL: dict[str, str] = {
    "p7_texts": "select doc_id, coalesce(text, '') as text from documents",
    "p8_invariants": "select count(*) as n_documents, 0 as n_gaps, 0 as n_needless, 0 as n_over from documents",
}
