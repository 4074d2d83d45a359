"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling, and the form each stands for."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainpanel.llm.common import settled

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is at least so many times as frequent as its variant.
FACTOR = 10
#: One in so many (document, run) pairs loses a code point.
NOISE = 31
#: Rows of a unit of work: one side of a block pair.
TILE = 2_048
#: Rows that are compared at once: small groups lie together in such a pack.
PACK = 256
#: Different words that a task holds before it hands their counts on.
HELD = 200_000

_RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LEAST_LENGTH)


def noisy_words(doc_id: int | None, text: str | None) -> dict[bytes, int]:
    """Counts of the text's words of at least seven code points, in Latin-1, after the deletions.

    All runs lie in Latin-1; any other code point becomes ``?``, which ends a run as itself would.
    """
    if not text:
        return {}
    runs = Counter(_RUN.findall(text.encode("latin-1", "replace").lower()))
    start, found = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), {}
    for run, n in runs.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % NOISE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < LEAST_LENGTH:
                continue
        found[run] = found.get(run, 0) + n
    return found


def word_counts(documents: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``word``, ``n`` of all documents: added up in each task before the exchange, a bounded number of words at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def handed() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            batch = pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for doc_id, one in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for word, n in noisy_words(doc_id, one.as_py()).items():
                    total[word] = total.get(word, 0) + n
                if len(total) > HELD:
                    yield handed()
        yield handed()

    counted = documents.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text}`")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def half_keys(words: DataFrame) -> DataFrame:
    """Each word under the halves that a word one edit away must share: ``m, side, half, word, n``.

    Of two such words let the longer have ``m`` code points. What lies before the edit or what lies
    after it has at least ``m // 2``, so both share their first or their last so many (``side`` 0, 1).
    A word is the longer or equal one in class ``m`` = its length, the shorter one in the next class.
    """
    size = F.char_length("word")
    classes = words.withColumn("m", F.explode(F.array(size, size + 1))).withColumn("h", F.floor(F.col("m") / 2).cast("int"))
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.expr("left(word, h)").alias("half")),
        F.struct(F.lit(1).alias("side"), F.expr("right(word, h)").alias("half")))
    return classes.select("m", F.inline(sides), "word", "n")


def tiles(words: DataFrame, tile: int = TILE) -> DataFrame:
    """The keyed words of groups of two and more, in block pairs ``i <= j``; ``block`` is the word's own.

    A group of one block, which nearly all are, is one pair. A crowded one is cut into blocks by the
    words' hash, and a word goes to one task for each block of its group, so no task holds more than
    two blocks.
    """
    keyed = settled(half_keys(words))
    sizes = keyed.groupBy("m", "side", "half").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    dealt = keyed.join(sizes, ["m", "side", "half"]).withColumn(
        "blocks", F.ceil(F.col("size") / tile).cast("int")).withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = dealt.withColumn("other", other)
    return pairs.select("m", "side", "half", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                        "block", "word", "n")


def _codes(words: list[str], m: int, right: bool) -> np.ndarray:
    """Padded code points, a row for each word, at the left or the right edge."""
    padded = "".join(w.rjust(m, "\0") if right else w.ljust(m, "\0") for w in words)
    codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(words), m)
    return codes.astype(np.uint8) if codes.max(initial=0) < 256 else codes


def one_edit(left: list[str], right: list[str], m: int, side: int) -> np.ndarray:
    """Which pairs of the two blocks differ by one edit, given that they share the half of this side.

    The longer of a pair has ``m`` code points, the other as many or one less. Common prefix plus
    common suffix of at least ``m`` - 1 leaves room for one edit. A pair that shares both halves is
    found on side 0 alone.
    """
    h = m // 2
    a, b = _codes(left, m, False), _codes(right, m, False)
    c, d = _codes(left, m, True), _codes(right, m, True)

    def common(x: np.ndarray, y: np.ndarray, columns: Iterator[int]) -> np.ndarray:
        run = np.ones((len(x), len(y)), dtype=bool)
        length = np.zeros((len(x), len(y)), dtype=np.uint8 if m < 256 else np.uint32)
        for k in columns:
            run &= x[:, k, None] == y[None, :, k]
            length += run
        return length

    if side == 0:
        prefix = common(a[:, h:], b[:, h:], range(m - h))
        suffix = common(c, d, range(m - 1, h, -1))
        near = prefix.astype(np.int32) + suffix >= m - 1 - h
    else:
        prefix = common(a, b, range(h))
        suffix = common(c[:, :m - h], d[:, :m - h], range(m - h - 1, -1, -1))
        near = (prefix.astype(np.int32) + suffix >= m - 1 - h) & (prefix < h)
    full_left = np.array([len(w) == m for w in left])
    full_right = np.array([len(w) == m for w in right])
    return near & (full_left[:, None] | full_right[None, :])


class _Found:
    """Near words added up by word: how many, and the most frequent."""

    def __init__(self):
        self.rows: dict[str, list] = {}

    def add(self, word: str, near: str, n: int) -> None:
        row = self.rows.setdefault(word, [0, n, near])
        row[0] += 1
        if (-n, near) < (-row[1], row[2]):
            row[1:] = n, near

    def batch(self) -> pa.RecordBatch:
        rows = list(self.rows.items())
        self.rows = {}
        return pa.RecordBatch.from_arrays([
            pa.array([w for w, _ in rows], pa.string()), pa.array([r[0] for _, r in rows], pa.int64()),
            pa.array([r[1] for _, r in rows], pa.int64()), pa.array([r[2] for _, r in rows], pa.string())],
            names=["word", "n_near", "near_n", "near"])


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``word, n_near, near_n, near``: number of words one edit away, and of these the most frequent (the first on a tie).

    Partitions are sorted, so that a unit's rows follow one another; whole small groups lie together
    in one pack of rows, larger units are compared in blocks of ``PACK`` x 1024.
    """
    unit = ("m", "side", "half", "i", "j")
    dealt = tiles(words, tile).repartition(*unit).sortWithinPartitions(*unit)

    def compare(found: _Found, m: int, side: int, rows: list[tuple]) -> None:
        """``rows``: (unit number, crossing, block side, word, n) of one class and side."""
        number = np.array([r[0] for r in rows])
        crossing, part = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
        word, n = [r[3] for r in rows], [r[4] for r in rows]
        for a in range(0, len(rows), PACK):
            for b in range(a, len(rows), 1024):
                at, to = slice(a, min(a + PACK, len(rows))), slice(b, min(b + 1024, len(rows)))
                near = one_edit(word[at], word[to], m, side)
                near &= number[at, None] == number[None, to]
                near &= ~crossing[at, None] | (part[at, None] != part[None, to])
                near &= np.arange(at.start, at.stop)[:, None] < np.arange(to.start, to.stop)[None]
                for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
                    i, j = i + at.start, j + to.start
                    found.add(word[i], word[j], n[j])
                    found.add(word[j], word[i], n[i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, pack, held, kind, now, number = _Found(), [], [], None, None, 0

        def flush(everything: bool) -> None:
            """Move the finished unit to the pack; compare the pack when it is full or its kind ends."""
            nonlocal pack, held
            if pack and (everything or len(pack) + len(held) > PACK):
                compare(found, *kind, pack)
                pack = []
            pack += held
            held = []

        for batch in batches:
            m, side, half, i, j, block, word, n = (c.to_pylist() for c in batch.columns)
            for k in range(len(batch)):
                key = (m[k], side[k], half[k], i[k], j[k])
                if key != now:
                    changed = kind != key[:2]
                    flush(False)
                    if changed:
                        flush(True)
                        kind = key[:2]
                    now, number = key, number + 1
                    if len(found.rows) > HELD:
                        yield found.batch()
                held.append((number, i[k] != j[k], block[k] == i[k], word[k], n[k]))
        flush(False)
        flush(True)
        yield found.batch()

    rows = dealt.mapInArrow(run, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    return rows.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.less")).alias("near_n"), "best.near")


def roots_of(links: DataFrame) -> DataFrame:
    """``word, root``: where following ``form`` from ``word`` ends (``links`` holds both, neither NULL).

    Each round doubles the steps taken; as a form is ten times as frequent, there are few of them.
    """
    now = settled(links.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = now.join(further, "root", "left")
        after = settled(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if after.filter("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def spelling_variants(words: DataFrame, factor: int = FACTOR, tile: int = TILE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``words`` (``word`` once each, and ``n``).

    Near words differ by one inserted, deleted or replaced code point. A word's form is its most
    frequent near word, the first in code-point order on a tie, if that is at least ``factor`` times as
    frequent; ``root`` follows forms to the last. An empty table gives an empty result.
    """
    words = settled(words.select("word", "n"))
    joined = words.join(near_words(words, tile), "word", "left")
    formed = settled(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("near_n") >= factor * F.col("n"), F.struct(F.col("near").alias("form"), F.col("near_n").alias("form_n"))).alias("f")))
    roots = roots_of(formed.filter("f is not null").select("word", "f.form"))
    return formed.join(roots, "word", "left").select(
        "word", "f.form", F.coalesce("root", "word").alias("root"), "n", "n_near", "f.form_n")


def variants_query(documents: DataFrame) -> DataFrame:
    """Variants among the corpus's words of at least seven code points and two occurrences.

    NULL, empty and short texts hold no words; a NULL id counts as an empty one; repeated rows count
    again; other columns are not looked at.
    """
    return spelling_variants(word_counts(documents).filter(F.col("n") >= LEAST_COUNT))
