"""From raw documents to packed training sequences.

``STAGES`` are applied in turn. Each takes (spark, docs, sf_dir), works on everything
its predecessor kept, and calls one operator of ``upkeep.llm``. Between stages the
documents are written as Parquet and read again. All stages but the last return the
columns they were given. Empty tables, null texts and null ids pass as the operators
define it; further columns stay.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm.language import UNKNOWN, held_out, identify, learn
from upkeep.llm.near_copies import near_copies
from upkeep.llm.packing import pack
from upkeep.llm.passages import passages
from upkeep.llm.spans import cut
from upkeep.llm.store import Kept, free_name, new_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"
SEQUENCE = 1024
END = 2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is known. Rejected are texts that are null or
    without letters, and ambiguous ones to which no language is half likely."""
    model = learn(docs.where(F.col("doc_id").isNotNull() & ~held_out()))
    name = free_name(docs, "language")
    found = identify(docs, model, name)
    rejected = (F.col(f"{name}.lang_pred") == UNKNOWN) | F.col(f"{name}.ambiguous") & (F.col(f"{name}.score") < 0.5)
    return found.where(~rejected).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each class; repeated rows once."""
    kept = Kept(spark)
    classes = kept.keep(near_copies(docs), "classes")
    rest = docs.join(classes.where("doc_id <> class_id").select("doc_id").hint("merge"), "doc_id", "left_anti")
    again = kept.keep(classes.groupBy("doc_id").agg(F.count("*").alias("n")).where("doc_id is not null and n > 1").select("doc_id"), "again")
    if not again.isEmpty():
        once = rest.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
        rest = rest.join(again, "doc_id", "left_anti").unionByName(once)
    return rest.select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one with a smaller doc_id has too. Those left
    without a word go; n_chars follows the text."""
    kept = Kept(spark)
    found = kept.keep(passages(docs), "passages")
    return cut(docs, found.where("role = 'copy'"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return pack(docs, public_tokenizers.path(TOKENIZER), END, SEQUENCE)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: Models, signatures and tokens are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what the last one returns."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
