"""SimHash near-duplicates by five-word similarity: wide fingerprints, pivot distance tables, exact verification.

At a Jaccard similarity of 0.8 some 15 % of a fingerprint's bits differ, ten of 64, too many for four blocks.
Fingerprints here have 256 bits, and every table has a block of sampled bits with pivots of its own. A pair is
a candidate where its distances to the pivots of one table differ by the same amounts (as they do where it
agrees on the block), its distances to the wide pivots differ by few bits, and so does the pair itself; it is
a link where the shingle sets themselves say so.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainpanel.llm.common import new_folder, settled
from rainpanel.llm.components import component_roots

SHINGLE, SIMILARITY, SEED = 5, 0.8, 42
WORDS = 4  # of 64 bits each
BITS = 64 * WORDS
#: Share of pairs at exactly the similarity that should meet in a table; above it nearly all do.
RECALL = 0.97
#: Sampled bits grow with the texts, so that unlike texts meet in cells of about this many rows.
CELL_ROWS, LEAST_BITS = 256, 16
#: Cells with more rows are cut into blocks, and every block meets every other.
CELL_LIMIT = 4_096
#: Tables of the first round, which joins most of a family by one link a row and table.
FIRST_TABLES = 8
#: Lower bits of a cell's number, which name its table.
TABLE_BITS = 12
#: Cells of at most so many rows may be verified by one table of common shingles.
DENSE_ROWS = 3_000
#: Pivots over all bits, for the coordinate filter.
WIDE_PIVOTS = 8
PRINT = [f"f{k}" for k in range(WORDS)]


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the different shingles; fewer words are one shingle, no word none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype="<u8")
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    view = memoryview(joined)
    hashes = [digest(view[a:b - 1], SEED) for a, b in zip([0, *ends], ends[min(shingle, len(words)) - 1:], strict=False)]
    return np.unique(np.array(hashes, dtype="<u8"))


def wide_print(shingles: np.ndarray) -> np.ndarray:
    """The fingerprint as ``WORDS`` longs: every hash is mixed into as many, and a bit is set in over half of them."""
    counts = np.zeros(BITS, dtype=np.int64)
    steps = np.arange(WORDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(shingles), 255):  # sums of 255 fit a byte
        mixed = shingles[at:at + 255, None] + steps
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(32)
        counts += np.unpackbits(mixed.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(shingles)).view("<i8")


def differing_share(similarity: float) -> float:
    """Expected share of bits that differ between sets of this Jaccard similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def table_plan(rows: int, similarity: float = SIMILARITY) -> tuple[int, int, int]:
    """Sampled bits of a table, number of tables, and the most bits in which a candidate may differ."""
    share = differing_share(similarity)
    bits = min(60, max(LEAST_BITS, math.ceil(math.log2(max(rows, 1) / CELL_ROWS))))
    tables = math.ceil(math.log(1 - RECALL) / math.log1p(-(1 - share) ** bits))
    return bits, tables, math.ceil(BITS * share + 3.5 * math.sqrt(BITS * share * (1 - share)))


def _marks(staged: DataFrame) -> DataFrame:
    """``row``, ``id``, two digests of the shingle set, and its fingerprint."""
    digests = [T.StructField(c, T.LongType()) for c in ("k0", "k1", *PRINT)]
    schema = T.StructType([staged.schema["row"], staged.schema["id"], *digests])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.empty((batch.num_rows, 2 + WORDS), dtype="<i8")
            for n, text in enumerate(batch.column(2)):
                shingles = shingle_set(text.as_py())
                found[n, :2] = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), "<i8")
                found[n, 2:] = wide_print(shingles)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c) for c in found.T.copy())], schema=_arrow_names(batch, schema))

    return staged.mapInArrow(run, schema)


def _arrow_names(batch: pa.RecordBatch, schema: T.StructType) -> pa.Schema:
    return pa.schema([batch.schema.field(0), batch.schema.field(1), *(pa.field(c, pa.int64()) for c in schema.names[2:])])


@cache
def block_pivots(bits: int, table: int) -> np.ndarray:
    """Reference patterns inside a table's block, one for each of its bits, a row of zeros and ones each."""
    return np.random.default_rng([7, table]).integers(0, 2, (bits, bits)).astype(np.float32)


@cache
def _mix(bits: int, table: int) -> np.ndarray:
    return np.random.default_rng([13, table]).integers(-(1 << 62), 1 << 62, bits) | 1


def pivot_cells(block: np.ndarray, table: int) -> np.ndarray:
    """The cell of each row of zeros and ones: by how much its distances to the pivots differ from that to zero.

    Rows that agree on the block lie at equal distances, so they share a cell.
    """
    pivots = block_pivots(block.shape[1], table)
    to_zero = block.sum(axis=1, dtype=np.int64)[:, None]
    distances = to_zero + (pivots.sum(axis=1) - 2 * (block.astype(np.float32) @ pivots.T)).astype(np.int64)
    return ((distances - to_zero) @ _mix(len(pivots), table) >> TABLE_BITS << TABLE_BITS) + table


def picked_bits(bits: int, tables: int) -> list[np.ndarray]:
    """The bits of every table's block."""
    draw = np.random.default_rng(5)
    return [draw.choice(BITS, size=bits, replace=False) for _ in range(tables)]


def coordinates(prints: np.ndarray) -> np.ndarray:
    """Distances of whole fingerprints to zero and to the wide pivots.

    By the triangle inequality two of them differ in no fewer bits than any of their coordinates does.
    """
    pivots = np.random.default_rng(11).integers(0, 1 << 64, (WIDE_PIVOTS, WORDS), dtype=np.uint64)
    pivots[0] = 0
    return np.bitwise_count(prints[:, None] ^ pivots).sum(axis=2, dtype=np.int16)


def _dealt(nodes: DataFrame, bits: int, tables: int) -> DataFrame:
    """Every row of ``nodes`` (``node``, fingerprint, ``part``) once for each table, with its ``cell`` there."""
    picks = picked_bits(bits, tables)
    names = ["cell", "node", "part", *PRINT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [batch.column(batch.schema.get_field_index(c)) for c in names[1:]]
            prints = np.column_stack([c.to_numpy() for c in own[2:]])
            flat = np.unpackbits(prints.view(np.uint8), axis=1)
            for n, pick in enumerate(picks):
                yield pa.RecordBatch.from_arrays([pa.array(pivot_cells(flat[:, pick], n)), *own], names=names)

    return nodes.select(names[1:]).mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _near(rows: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers of pairs of one cell and different parts at most ``most`` bits apart, and how many; rows lie by cells."""
    cell, part, prints = rows[:, 0], rows[:, 2], np.ascontiguousarray(rows[:, 3:]).view(np.uint64)
    places = coordinates(prints)
    first, step = np.arange(len(rows)), 1
    while True:
        first = first[first + step < len(rows)]
        first = first[cell[first] == cell[first + step]]
        if not len(first):
            return
        left = first[part[first] != part[first + step]]
        left = left[(np.abs(places[left] - places[left + step]) <= most).all(axis=1)]
        apart = np.bitwise_count(prints[left] ^ prints[left + step]).sum(axis=1, dtype=np.int64)
        close = apart <= most
        if close.any():
            yield left[close], left[close] + step, apart[close]
        step += 1


def _mixed(rows: np.ndarray) -> np.ndarray:
    """Which rows lie in cells of several parts; others have nothing to add."""
    starts = np.flatnonzero(np.diff(rows[:, 0], prepend=rows[0, 0] - 1))
    several = np.minimum.reduceat(rows[:, 2], starts) < np.maximum.reduceat(rows[:, 2], starts)
    return np.repeat(several, np.diff(starts, append=len(rows)))


def _by_cells(dealt: DataFrame, run_cells, schema: str) -> DataFrame:
    """``run_cells`` over arrays of whole cells (``cell``, ``node``, ``part``, fingerprint)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.empty((0, 3 + WORDS), dtype=np.int64)
        for batch in batches:
            rows = np.concatenate([kept, np.column_stack([c.to_numpy() for c in batch.columns])])
            if not len(rows):
                continue
            whole = int(np.searchsorted(rows[:, 0], rows[-1, 0]))  # the last cell may go on
            kept = rows[whole:]
            if whole:
                yield from run_cells(rows[:whole])
        if len(kept):
            yield from run_cells(kept)

    return dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, schema)


def _cut(dealt: DataFrame, every: bool) -> DataFrame:
    """``dealt`` with crowded cells in blocks: each meets all others where ``every`` pair is asked for."""
    crowded = settled(dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), (F.min("part") < F.max("part")).alias("mixed")).filter(
        F.col("n") > CELL_LIMIT))
    if crowded.isEmpty():
        return dealt
    blocks = F.when(F.col("mixed"), F.ceil(F.col("n") / CELL_LIMIT).cast("int")).otherwise(0)
    cut = dealt.join(crowded.select("cell", blocks.alias("blocks")), "cell", "left").withColumn(
        "mine", F.when(F.col("blocks") > 0, F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))

    def meeting(b: Column) -> Column:
        named = F.xxhash64(F.col("cell"), F.least(b, F.col("mine")), F.greatest(b, F.col("mine")))
        low = F.lit((1 << TABLE_BITS) - 1)
        return named.bitwiseAND(F.bitwise_not(low)).bitwiseOR(F.col("cell").bitwiseAND(low))

    meetings = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), meeting) if every else F.array(meeting(F.col("mine")))
    cells = F.when(F.col("blocks").isNull(), F.array("cell")).when(F.col("blocks") > 0, meetings)  # of one part: no pair
    return cut.withColumn("cell", F.explode(cells)).drop("blocks", "mine")


def _first_pairs(dealt: DataFrame, most: int) -> DataFrame:
    """Candidate pairs ``a``, ``b``: each row's nearest earlier one of its cell, at most ``most`` bits away."""
    def pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = rows[_mixed(rows)]
        node, near, nearest = rows[:, 1], np.full(len(rows), BITS + 1), np.zeros(len(rows), dtype=np.int64)
        for left, right, apart in _near(rows, most):
            better = apart < near[right]
            near[right[better]], nearest[right[better]] = apart[better], left[better]
        linked = near <= BITS
        x, y = node[linked], node[nearest[linked]]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    return _by_cells(_cut(dealt, every=False), pairs, "a long, b long").distinct()


def _own_pairs(rows: np.ndarray, picks: list[np.ndarray], most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs of the cells, as row numbers; one that meets in several tables belongs to the first of them."""
    flat = np.unpackbits(np.ascontiguousarray(rows[:, 3:]).view(np.uint8), axis=1)
    cells = np.column_stack([pivot_cells(flat[:, pick], n) for n, pick in enumerate(picks)])
    table, found = rows[:, 0] & ((1 << TABLE_BITS) - 1), []
    for left, right, _ in _near(rows, most):
        own = np.argmax(cells[left] == cells[right], axis=1) == table[left]
        found.append((left[own], right[own]))
    return found


def _other_links(dealt: DataFrame, staged: DataFrame, picks: list[np.ndarray], most: int, similarity: float) -> DataFrame:
    """All links ``a``, ``b`` between different parts: candidates are verified in their cells, and only links leave them.

    Rows with a candidate of their table get their texts, so the rows grow with the tables and not with the pairs.
    """
    names = ["cell", "node", "part", *PRINT]
    schema = ", ".join(f"{c} long" for c in names)

    def meet(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = rows[_mixed(rows)]
        met = np.zeros(len(rows), dtype=bool)
        if len(rows):
            for left, right in _own_pairs(rows, picks, most):
                met[left] = met[right] = True
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows[met].T.copy()], names=names)

    def links(rows: np.ndarray, sets: list[np.ndarray]) -> pa.RecordBatch:
        left, right = (np.concatenate(x) for x in zip(*[(np.empty(0, dtype=np.int64),) * 2, *_own_pairs(rows, picks, most)], strict=True))
        sizes, shared = np.array([len(x) for x in sets]), np.zeros(len(left))
        starts = np.flatnonzero(np.diff(rows[:, 0], prepend=rows[0, 0] - 1))
        cell = np.searchsorted(starts, left, side="right") - 1
        order = np.argsort(cell, kind="stable")
        for pairs in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1) if len(left) else ():
            at = starts[cell[pairs[0]]]
            end = starts[cell[pairs[0]] + 1] if cell[pairs[0]] + 1 < len(starts) else len(rows)
            shared[pairs] = common(sets[at:end], left[pairs] - at, right[pairs] - at)
        alike = shared >= similarity / (1 + similarity) * (sizes[left] + sizes[right]) - 1e-9
        x, y = rows[left[alike], 1], rows[right[alike], 1]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sets, size = [], [], 0  # whole cells, a million shingles or somewhat more at a time
        for batch in batches:
            rows = np.column_stack([c.to_numpy() for c in batch.columns[:-1]]) if batch.num_rows else ()
            for row, text in zip(rows, batch.column(len(names)), strict=True):
                if size > 1 << 20 and held[-1][0] != row[0]:
                    yield links(np.array(held), sets)
                    held, sets, size = [], [], 0
                held.append(row)
                sets.append(shingle_set(text.as_py()))
                size += len(sets[-1])
        if held:
            yield links(np.array(held), sets)

    met = settled(_by_cells(_cut(dealt, every=True), meet, schema))
    texts = settled(staged.select(F.col("row").alias("node"), "text").join(met.select("node").distinct(), "node", "left_semi"))
    whole = met.join(texts, "node").select(*names, "text")
    return whole.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long")


def common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many elements the sets of each pair share: by a table of those in several sets, or pair by pair."""
    if not len(left):
        return np.empty(0)
    ends = np.cumsum([len(x) for x in sets])
    _, which, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1
    width = int(number[-1]) + 1 if len(number) else 0
    if len(sets) > DENSE_ROWS or len(sets) ** 2 * width > 1e5 * len(left):
        return np.array([np.isin(sets[a], sets[b], assume_unique=True).sum() for a, b in zip(left, right, strict=True)])
    row, shared = np.repeat(np.arange(len(sets)), np.diff(ends, prepend=0)), counts[which] > 1
    row, column, total = row[shared], number[which[shared]], np.zeros((len(sets), len(sets)), dtype=np.float32)
    for at in range(0, width, 1024):
        table, here = np.zeros((len(sets), 1024), dtype=np.float32), (column >= at) & (column < at + 1024)
        table[row[here], column[here] - at] = 1
        total += table @ table.T
    return total[left, right]


def _verified(pairs: DataFrame, staged: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose shingle sets have the similarity; sets are made for rows of a pair only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sets, held = [], [], 0
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows.append(row)
                sets.append(shingle_set(text.as_py()).view("<i8"))
                held += len(sets[-1])
                if held > 1 << 20:
                    yield listed(rows, sets)
                    rows, sets, held = [], [], 0
            if rows:
                yield listed(rows, sets)

    def listed(rows: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets)))], names=["node", "shingles"])

    ends = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    sets = settled(staged.select("row", "text").join(ends, "row", "left_semi").mapInArrow(run, "node long, shingles array<long>"))
    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    shared = F.size(F.array_intersect("x", "y"))
    need = similarity / (1 + similarity) * (F.size("x") + F.size("y"))
    return both.filter(shared >= need - 1e-9).select("a", "b")


def _nodes(marked: DataFrame) -> DataFrame:
    """One row for each different shingle set: a row number, the first document and the fingerprint."""
    order = F.struct(F.col("id").isNull(), "id", "row")
    return settled(marked.groupBy("k0", "k1").agg(
        F.min("row").alias("node"), F.min(order).alias("first"), *(F.first(c).alias(c) for c in PRINT)))


def _rooted(nodes: DataFrame, staged: DataFrame, similarity: float) -> DataFrame:
    """``nodes`` with ``root``, one value for all that links join.

    The first tables bring one link for each row of a cell, and what these join are parts. Then all tables bring
    all links between different parts. So no link is lost and the members of a large family, though each may be
    near to every other, are not paired with each other.
    """
    bits, tables, most = table_plan(nodes.count(), similarity)
    texts = nodes.select("node", *PRINT)
    found = settled(_first_pairs(_dealt(texts.withColumn("part", F.col("node")), bits, min(tables, FIRST_TABLES)), most))
    links = settled(_verified(found, staged, similarity))
    parts = component_roots(links)
    parted = settled(texts.join(parts, "node", "left").withColumn("part", F.coalesce("root", "node")).drop("root"))
    links = links.unionAll(_other_links(_dealt(parted, bits, tables), staged, picked_bits(bits, tables), most, similarity))
    roots = component_roots(links)
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _staged(documents: DataFrame, id_col: str, text: str) -> DataFrame:
    """A written copy: whole rows inside ``doc``, so that no name can clash, each with a number of its own."""
    folder = new_folder(documents.sparkSession, "near-copies")
    documents.select(F.struct("*").alias("doc")).withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    return documents.sparkSession.read.parquet(folder).select(
        "row", F.col("doc").getField(id_col).alias("id"), F.col("doc").getField(text).alias("text"), "doc")


def near_groups(documents: DataFrame, id_col: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``id_col`` and ``component_id`` (smallest id reachable over links of the similarity) for every row.

    Words are runs of anything but ASCII blanks, A-Z in lower case; shingles are sets. NULL, empty and blank
    texts are one group, texts below five words are one shingle. Repeated rows give repeated rows, NULL ids
    count only in groups that have no other; an empty table gives an empty result.
    """
    staged = _staged(documents, id_col, text)
    marked = settled(_marks(staged.select("row", "id", "text")))
    rooted = _rooted(_nodes(marked), staged, similarity)
    lowest = rooted.groupBy("root").agg(F.min("first").alias("least"))
    groups = rooted.select("k0", "k1", "root").join(lowest, "root").select("k0", "k1", F.col("least.id").alias("component_id"))
    return marked.select("k0", "k1", F.col("id").alias(id_col)).join(groups, ["k0", "k1"]).select(id_col, "component_id")


def keep_one_each(documents: DataFrame, id_col: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of every group of :func:`near_groups`: the smallest id, and of its repeated rows any one.

    Columns are kept, whatever their names. Rows are told apart by numbers of a written copy, so repeated ids
    and rows stay apart and the last join is even.
    """
    staged = _staged(documents, id_col, text)
    marked = settled(_marks(staged.select("row", "id", "text")))
    chosen = _rooted(_nodes(marked), staged, similarity).groupBy("root").agg(F.min("first").alias("first")).select("first.row")
    return staged.join(chosen, "row", "left_semi").select("doc.*")
