"""SimHash near-duplicates: pivot distance tables, a coordinate filter, then exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainpanel.llm.common import settled
from rainpanel.llm.components import component_roots

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: The 64 bits fall into so many blocks; every block has so many reference fingerprints.
BLOCKS, PIVOTS_PER_BLOCK = 4, 12
#: Cells with more fingerprints are not compared pair by pair but linked through one-bit neighbours.
CELL_LIMIT = 2_000


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of the whole text: bits set in over half the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]).tolist()
        starts = [0, *ends]
        view, digest = memoryview(joined), xxhash.xxh64_intdigest
        hashes = [digest(view[a:b - 1], SEED) for a, b in zip(starts, ends[shingle - 1:], strict=False)]
    return _majority(np.array(hashes, dtype="<u8"))


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a bounded part at a time
        part = hashes[at:at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def add_fingerprints(documents: DataFrame, text: str = "text", name: str = "__fp", keep: list[str] | None = None) -> DataFrame:
    """``documents`` (or its columns ``keep``) with the fingerprint as a long."""
    columns = documents.columns if keep is None else keep
    schema = T.StructType([*(documents.schema[c] for c in columns), T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            prints = pa.array((fingerprint_of(t.as_py()) for t in texts), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), prints], names=[*columns, name])

    needed = list(dict.fromkeys([*columns, text]))
    return documents.select(*(f"`{c}`" for c in needed)).mapInArrow(run, schema)


def pivots(blocks: int = BLOCKS, per_block: int = PIVOTS_PER_BLOCK) -> list[list[int]]:
    """Reference fingerprints, by block: random bits inside the block and zeros elsewhere."""
    width, draw = 64 // blocks, np.random.default_rng(11)
    found = []
    for k in range(blocks):
        patterns = draw.choice(np.arange(1, 2 ** width), size=per_block, replace=False)
        found.append([int(np.array(int(p) << (k * width), dtype=np.uint64).view(np.int64)) for p in patterns])
    return found


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def pivot_table(prints: DataFrame, fp: str = "fp") -> DataFrame:
    """``prints`` with ``coords``: distances to the zero pivot (first) and to all others, one byte each."""
    near = [F.bit_count(F.col(fp))] + [distance(F.col(fp), F.lit(p)) for block in pivots() for p in block]
    return prints.withColumn("coords", F.array(*(c.cast("tinyint") for c in near)))


def cells(table: DataFrame) -> DataFrame:
    """Each fingerprint once for every way to choose blocks that a near one must share.

    Bits that differ touch at most ``MAX_BITS`` blocks, so two near fingerprints agree on the other
    ``BLOCKS - MAX_BITS``. The pivots of an agreed block lie at distances that differ from the zero
    pivot's by the same amounts for both; those differences are the cell.
    """
    def offsets(block: int) -> list[Column]:
        first = 1 + block * PIVOTS_PER_BLOCK
        return [F.get("coords", F.lit(first + j)) - F.get("coords", F.lit(0)) for j in range(PIVOTS_PER_BLOCK)]

    keys = [
        F.xxhash64(F.lit(n), *(c for block in shared for c in offsets(block)))
        for n, shared in enumerate(combinations(range(BLOCKS), BLOCKS - MAX_BITS))]
    return table.select("fp", "coords", F.explode(F.array(*keys)).alias("cell"))


def near_pairs(prints: DataFrame) -> DataFrame:
    """Edges ``a``, ``b`` that connect all fingerprints (distinct, column ``fp``) within ``MAX_BITS`` bits.

    Pairs of a cell are dropped where any pivot distance differs by more than ``MAX_BITS``, which by
    the triangle inequality loses nothing; the rest are verified bit by bit, both inside the join,
    so only links leave it. Cells over ``CELL_LIMIT`` fingerprints take the exact other way of
    :func:`_through_neighbours`, whose rows grow with the fingerprints and not with their pairs.
    """
    dealt = settled(cells(pivot_table(prints)))
    full = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sized = dealt.join(full, "cell")
    small = sized.filter(F.col("n") <= CELL_LIMIT)
    left, right = small.alias("x"), small.alias("y")
    # One comparison after another, so that most pairs end at the first few pivots.
    near = reduce(and_, (
        F.abs(F.get("x.coords", F.lit(k)) - F.get("y.coords", F.lit(k))) <= MAX_BITS
        for k in range(1 + BLOCKS * PIVOTS_PER_BLOCK)))
    close = near & (distance(F.col("x.fp"), F.col("y.fp")) <= MAX_BITS)
    pairs = left.join(right, (F.col("x.cell") == F.col("y.cell")) & (F.col("x.fp") < F.col("y.fp")) & close)
    crowded = sized.filter(F.col("n") > CELL_LIMIT).select("fp").distinct()
    return pairs.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).unionAll(_through_neighbours(crowded))


def _through_neighbours(prints: DataFrame) -> DataFrame:
    """Links through fingerprints one bit away: two within 2 bits share one, and sharers are within 2 bits."""
    flips = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(1 << k if k < 63 else -(1 << 63))) for k in range(64)))
    around = prints.select("fp", F.explode(flips).alias("z"))
    first = around.groupBy("z").agg(F.min("fp").alias("a"), F.max("fp").alias("m")).filter("a <> m")
    return around.join(first, "z").filter("fp <> a").select("a", F.col("fp").alias("b"))


def group_documents(marked: DataFrame, id_col: str, fp: str = "__fp") -> DataFrame:
    """``marked`` (settled ids and fingerprints) with ``__root``, one value a group, and ``component_id``, its smallest id."""
    prints = settled(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(id_col).alias("first")))
    roots = component_roots(near_pairs(prints.select("fp")))
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "__root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("__root").agg(F.min("first").alias("component_id"))
    return marked.join(rooted.join(lowest, "__root").select(F.col("fp").alias(fp), "__root", "component_id"), fp)


def simhash_groups(documents: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` for every row.

    Texts are read once, whole. Documents of one fingerprint are one node, so copies cost nothing
    more. NULL, empty and blank texts share fingerprint zero and are linked like any other; texts
    below three words hash as a whole; repeated rows give repeated rows; NULL ids are ignored where
    a component has another; an empty table gives an empty result.
    """
    marked = settled(add_fingerprints(documents, text, keep=[id_col]))
    grouped = group_documents(marked, id_col)
    digits = F.lower(F.lpad(F.hex("__fp"), 16, "0"))
    return grouped.select(id_col, digits.alias("fingerprint"), "component_id")
