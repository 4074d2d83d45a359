"""Importance resampling to a target's distribution of hashed words and word pairs.

The method is that of Xie and others, "Data Selection for Language Models via Importance Resampling"
(2023): a document's weight is the mean log ratio of its features in the target and in the corpus, and
the highest weights with Gumbel noise are a draw without replacement. Features are counted a batch of
texts at a time, all texts joined to one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainpanel.llm.common import new_folder, settled
from rainpanel.llm.sharding import assign_shards

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Bytes of text that are joined at once.
JOINED = 2_000_000

#: Between texts: not a word character, and no text holds it once its own are blanks.
SENTINEL = b"\x00"
#: A word in lower-case UTF-8 (every byte beyond ASCII belongs to one), or the end of a text.
_TOKEN = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+|\x00")


def batch_features(texts: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of UTF-8 texts: bucket and text number of every feature, and words of each text.

    One pass of the pattern finds the words of all texts and the sentinels between them; the places of
    the sentinels tell the text of each word and which pairs of neighbours lie in two texts.
    """
    tokens = _TOKEN.findall(SENTINEL.join(t.lower().replace(SENTINEL, b" ") for t in texts))
    n = len(tokens)
    word_crc = list(map(crc32, tokens))
    pair_crc = map(crc32, tokens[1:], map(crc32, repeat(b" "), word_crc))
    single = np.array(word_crc, dtype=np.uint32)
    double = np.fromiter(pair_crc, dtype=np.uint32, count=max(n - 1, 0))
    is_word = np.fromiter(map(SENTINEL.__ne__, tokens), dtype=bool, count=n)
    ends = np.nonzero(~is_word)[0]
    text = np.searchsorted(ends, np.arange(n))
    both = is_word[1:] & is_word[:-1]
    bucket = np.concatenate([single[is_word], double[both]]) % np.uint32(buckets)
    owner = np.concatenate([text[is_word], text[1:][both]])
    return bucket, owner, np.bincount(text[is_word], minlength=len(texts))


def _parts(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a batch, a bounded number of bytes at a time, with the place of the first."""
    begin, part, size = 0, [], 0
    for i, text in enumerate(column):
        one = text.as_buffer().to_pybytes() if text.is_valid else b""
        if part and size + len(one) > JOINED:
            yield begin, part
            begin, part, size = i, [], 0
        part.append(one)
        size += len(one)
    if part:
        yield begin, part


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: features of all texts in each bucket; a task sends one row a bucket at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, part in _parts(batch.column(0)):
                total += np.bincount(batch_features(part, buckets)[0], minlength=buckets)
        held = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    return texts.select(F.col(f"`{text}`")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """1000 times the log ratio of each bucket's share in the target and in the corpus, floored.

    Counts are of all texts. One number for each bucket comes to the driver from either side.
    """
    def counted(frame: DataFrame) -> np.ndarray:
        found = np.zeros(buckets)
        for bucket, n in bucket_counts(frame, text, buckets).collect():
            found[bucket] = n
        return found

    s, t = counted(documents), counted(target)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weights(documents: DataFrame, gain: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of every row, ``n_words``, ``n_features`` and ``weight``, the floored mean gain of its features."""
    shared = documents.sparkSession.sparkContext.broadcast(gain)  # a number for each bucket
    schema = T.StructType([*(documents.schema[c] for c in keep), *(
        T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = shared.value
        for batch in batches:
            words, total = np.zeros(len(batch), dtype=np.int64), np.zeros(len(batch))
            for begin, part in _parts(batch.column(batch.schema.get_field_index(text))):
                bucket, owner, n = batch_features(part, len(value))
                words[begin:begin + len(part)] = n
                total[begin:begin + len(part)] = np.bincount(owner, value[bucket], minlength=len(part))
            features = words + np.maximum(words - 1, 0)
            weight = total.astype(np.int64) // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in keep), *map(pa.array, (words, features, weight))],
                names=schema.names)

    needed = list(dict.fromkeys([*keep, text]))
    return documents.select(*(f"`{c}`" for c in needed)).mapInArrow(run, schema)


def gumbel(identity: Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel number drawn from the identity's hash, floored."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def importance(
    documents: DataFrame, target: DataFrame, keep: list[str], id_col: str = "doc_id", text: str = "text",
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS,
) -> DataFrame:
    """Columns ``keep`` (with ``id_col``) of every row, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the rows with at least ``least_words`` words, ``percent`` of a hundred are drawn, rounded down:
    those of the highest score, of equals the smaller id. ``rank`` is their order from 1, NULL for the
    rest. The order is made by range partitions and prefix counts; no partition holds more than its
    range, however many scores are equal.

    NULL and empty texts have no features and weight 0; a NULL id hashes as an empty one and comes last
    among equals; repeated rows are drawn each on its own; an empty target gives every bucket its share
    of the added counts; an empty table gives an empty result. Columns not in ``keep`` are not looked at.
    """
    weighed = weights(documents, gains(documents, target, text, buckets), keep, text)
    scored = settled(weighed.withColumn("score", F.col("weight") + gumbel(F.col(f"`{id_col}`"), seed)))
    able = scored.filter(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    ordered = assign_shards(
        able.select("*", (-F.col("score")).alias("__down"), F.col(f"`{id_col}`").isNull().alias("__last"), F.lit(0).alias("__none")),
        "__none", ("__down", "__last", id_col), 1)
    rank = F.when(F.col("slot") < drawn, F.col("slot") + 1)
    columns = [F.col(f"`{c}`") for c in scored.columns]
    rest = scored.filter(F.col("n_words") < least_words)
    return ordered.select(*columns, rank.alias("rank")).unionByName(rest.select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(documents: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The drawn rows with their own columns; ``settings`` are those of :func:`importance`.

    Rows get a number of their own in a written copy, which the draw refers to.
    """
    folder = new_folder(documents.sparkSession, "resampling")
    documents.withColumn("__row", F.monotonically_increasing_id()).write.parquet(folder)
    staged = documents.sparkSession.read.parquet(folder)
    chosen = importance(staged, target, [id_col, "__row"], id_col, text, **settings).filter("rank is not null").select("__row")
    return staged.join(chosen, "__row", "left_semi").select(*(f"`{c}`" for c in documents.columns))


def resampling_query(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return importance(documents, benchmark, ["doc_id"]).select("doc_id", "n_features", "weight", "score", "rank", "n_words")
