"""One query per operator over the driver tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm.blocks import token_blocks
from upkeep.llm.bpe import digests
from upkeep.llm.byte_bpe import digests as byte_digests
from upkeep.llm.fingerprints import edited_fingerprints, fingerprint_classes
from upkeep.llm.language import languages
from upkeep.llm.merkle import manifest_rows
from upkeep.llm.near_copies import near_copies
from upkeep.llm.negatives import hard_negatives, quantized
from upkeep.llm.packing import pack
from upkeep.llm.passages import passages
from upkeep.llm.shards import sharding
from upkeep.llm.suffixes import repeats
from upkeep.llm.vectors import nearest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, through files of patched frame-of-reference blocks."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_blocks(spark, docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts encoded by speculation and check, and decoded again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs, public_tokenizers.path("word_bpe_49k.json"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, size=1024)


@query
def op10_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose five-word shingles have a weighted similarity of 0.8 or more."""
    return near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query
def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that stand, nearly alike, in another document."""
    return passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that stand word for word in another document."""
    return repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query
def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled into 16 shards of equal numbers of rows."""
    return sharding(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=16)


@query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of whole and of edited texts, and classes of near fingerprints."""
    return fingerprint_classes(edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet")))


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text by error-correcting output codes."""
    return languages(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every hundredth vector, by counting collisions."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0, k=10)


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that score 30 to 90 percent of each anchor's best five of its own."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = quantized(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label)
    return hard_negatives(rows, F.col("id") % 100 == 0)


ORACLES["op11_hard_negatives"] = """
    WITH usable AS (
        SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scores AS (
        SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
               CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
        FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10"""


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts encoded by backtracking over byte-level ranks, and decoded again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return byte_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Merkle tree over all documents, and every document's proof tried on what it may have become."""
    return manifest_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
