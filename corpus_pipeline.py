"""The corpus pipeline: documents are filtered, thinned and encoded, one operator after the other.

Every stage works on all rows that its predecessor kept, and each result is written before the next stage reads it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import byte_bpe, decontaminate, line_dedup, near_copies, toxicity
from tidegrid.llm.queries import table
from tidegrid.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is fitted on labelled rows of its own input."""
    # Whole rows go through Python from here on: a batch is bounded by bytes, not by 10,000 rows.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", near_copies.BATCH_BYTES)
    return toxicity.remove(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are on many sites stay at their first place only; n_chars follows the text."""
    return line_dedup.strip(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, Jaccard similarity of 0.8 or more.

    Of what stays, lines of over 50 words that two documents have stay in the first; n_chars follows the text. Before copies
    are gone this would cut every copy to pieces.
    """
    kept = stage(near_copies.keep_one(docs), "kept")
    return line_dedup.strip_passages(kept).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, decoded again; counts and digests per document."""
    ranks = byte_bpe.read_ranks(byte_bpe.tokenizer_file(spark))
    return byte_bpe.digests(docs, ranks, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_texts),
    ("line_dedup", boilerplate_lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]
# SQL has neither the classifier nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stage(docs, name)
    return docs
