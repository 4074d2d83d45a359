"""From raw documents to packed training sequences: toxicity, quality, near-duplicates, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. The filters return
the columns they were given; the last stage returns a row for each packed piece. A stage on an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rainpanel.llm import near_copies, packing, quality, toxicity
from rainpanel.llm.common import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled examples do not call them toxic."""
    return toxicity.keep_harmless(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the table of quality thresholds."""
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates (five-word similarity of 0.8 or more), that of the smallest id.

    SimHash fingerprints meet by pivot distance tables, pass a coordinate filter and a bit-by-bit check, and are
    linked where the shingle sets themselves are alike enough; star contraction makes the groups.
    NULL, empty and blank texts are one group; other columns pass through, whatever their names.
    """
    return near_copies.keep_one_each(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 1024 tokens."""
    return packing.packing_query(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("SimHash near-dedup", drop_near_copies),
    ("packing", pack_sequences),
]

#: Scores from nearest examples and shingle hashes are beyond SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
