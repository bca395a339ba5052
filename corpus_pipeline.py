"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept and
returns the columns of documents; the last returns the pieces of the sequences.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from boxtrail.llm import importance, line_dedup, minhash_dedup, pack, substring_dedup
from boxtrail.llm.common import ROW, packed, ship, stored, table, unpacked


def _with_text(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of documents with the kept text and its length."""
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return unpacked(found, docs, **{c: v for c, v in new.items() if c in docs.columns})


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards the labelled good ones; the others go."""
    labels = importance.judged(table(spark, sf_dir, "labels"))
    return importance.keep_sampled(
        docs,
        importance.target_ids(labels),
        importance.good_share(labels),
        marks=importance.toxic_words(docs, labels),
    )


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that resemble an earlier line go; the documents stay, if empty."""
    return _with_text(line_dedup.remove_lines(docs), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return minhash_dedup.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go; a null text becomes empty."""
    found = substring_dedup.remove_repeats(docs, keep={ROW: packed(docs)})
    return _with_text(found, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of one mixture."""
    return pack.pack(docs).withColumn("ids_crc32", F.crc32("ids")).withColumnRenamed(
        "queue", "source"
    )


def _shipped(stage):
    @wraps(stage)
    def call(spark, docs, sf_dir):
        ship(spark)
        return stage(spark, docs, sf_dir)

    return call


STAGES = [
    ("quality", _shipped(quality)),
    ("line_dedup", _shipped(lines)),
    ("minhash_dedup", _shipped(near_duplicates)),
    ("substring_dedup", _shipped(passages)),
    ("packing", _shipped(packing)),
]

#: Hash functions and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
