"""Sequence packing: shallow length combinations solved by non-negative least squares."""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainpanel.llm.common import SPACE_IN_RUN, settled

WINDOW = 1024
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
#: Different space-separated chunks that a task remembers the ids of.
REMEMBERED = 250_000


class ChunkEncoder:
    """Ids of whole texts as a ``tokenizers`` byte-level BPE file gives them, remembering those of chunks.

    The pattern starts a new piece at every space that white space does not surround, so a text's ids
    are those of its space-separated chunks, each with the space before it; texts with a space inside
    or at the end of a run of any white space are encoded whole. Chunks go through ``tiktoken`` with the file's own vocabulary, whose ids are its ranks:
    the ids are the same and come several times sooner. Texts that may name a special token are left
    to ``tokenizers``.
    """

    def __init__(self, file: bytes, remembered: int = REMEMBERED):
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer, self.remembered = Tokenizer.from_buffer(file), remembered
        special = {t["content"] for t in json.loads(file)["added_tokens"]}
        byte_of = _byte_alphabet()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in self.tokenizer.get_vocab(False).items() if token not in special}
        self.fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def _learn(self, chunk: str) -> bytes:
        if len(self.known) >= self.remembered:
            self.known.clear()
        self.known[chunk] = found = array("I", self.fast.encode_ordinary(chunk)).tobytes()
        return found

    def encode(self, texts: Sequence[str | None]) -> Iterator[bytes]:
        """Each text's ids as little-endian 32-bit numbers."""
        known = self.known
        for text in texts:
            text = text or ""
            if "<|" in text:
                yield array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            elif SPACE_IN_RUN.search(text):
                yield array("I", self.fast.encode_ordinary(text)).tobytes()
            else:
                first, *rest = text.split(" ")
                yield b"".join([known.get(c) or self._learn(c) for c in (first, *(" " + c for c in rest))])


def _byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def pieces(
    documents: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID,
    file: str | None = None, carry_ids: bool = False,
) -> DataFrame:
    """Every document's ids and ``end_id``, cut into full windows and a rest, one row each.

    Columns: ``key``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``ids`` (array, only
    with ``carry_ids``), and the task's number and the rank of the piece among those of its length
    there, from which ranks over all tasks follow.
    """
    spark = documents.sparkSession
    with open(file or public_tokenizers.path(TOKENIZER), "rb") as source:  # the driver's; a vocabulary has a fixed size
        shared = spark.sparkContext.broadcast(source.read())
    schema = f"`{key}` {documents.schema[key].dataType.simpleString()}, start long, length int, ids_crc32 long, doc_tokens long, " + (
        "ids array<int>, " if carry_ids else "") + "__part int, __rank long"
    tail = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ranks, part = ChunkEncoder(shared.value), [0] * (window + 1), TaskContext.get().partitionId()
        for batch in batches:
            source, rows = [], []
            for i, ids in enumerate(encoder.encode(batch.column(1).to_pylist())):
                view = memoryview(ids + tail)
                total = len(view) // 4
                for start in range(0, total, window):
                    piece = view[4 * start:4 * (start + window)]
                    length = len(piece) // 4
                    source.append(i)
                    rows.append((start, length, zlib.crc32(piece), total, ranks[length], bytes(piece) if carry_ids else b""))
                    ranks[length] += 1
            start, length, crc, total, rank, ids = zip(*rows, strict=True) if rows else ((),) * 6
            lists = [pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32()))] if carry_ids else []
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(source, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int32()),
                pa.array(crc, pa.int64()), pa.array(total, pa.int64()), *lists,
                pa.array([part] * len(rows), pa.int32()), pa.array(rank, pa.int64())],
                names=[key, "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if carry_ids else []), "__part", "__rank"])

    return documents.select(f"`{key}`", f"`{text}`").mapInArrow(run, schema)


@dataclass
class Plan:
    """Combinations of lengths and how often each is repeated."""

    combinations: list[tuple[int, ...]]
    repeats: list[int]

    def places(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By length: first rank of each run of pieces, the run's first sequence, the offset in each."""
        used: dict[int, int] = {}
        found: dict[int, list[tuple[int, int, int]]] = {}
        sequence = 0
        for lengths, n in zip(self.combinations, self.repeats, strict=True):
            offset = 0
            for length in lengths:
                found.setdefault(length, []).append((used.get(length, 0), sequence, offset))
                used[length] = used.get(length, 0) + n
                offset += length
            sequence += n
        return {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v, strict=True)) for k, v in found.items()}


def shallow_combinations(window: int) -> np.ndarray:
    """All ways to fill the window with two or three lengths (rows, longest first, 0 for none)."""
    pairs = [(a, window - a, 0) for a in range(-(-window // 2), window)]
    triples = []
    for a in range(-(-window // 3), window - 1):
        b = np.arange(max(-(-(window - a) // 2), 1), min(a, window - a - 1) + 1)
        triples.append(np.stack([np.full_like(b, a), b, window - a - b], axis=1))
    return np.concatenate([np.array(pairs, dtype=np.int64).reshape(-1, 3), *triples])


def solve_repeats(combos: np.ndarray, histogram: np.ndarray, rounds: int = 48, tries: int = 96) -> np.ndarray:
    """Non-negative repeats whose use of lengths is nearest the histogram (an active-set method).

    Combinations enter many at a time, no two of them sharing a length, where they lower the error
    most; those pushed below zero leave again. Short lengths weigh less: they also fill gaps.
    """
    window = len(histogram) - 1
    weight = np.sqrt(np.arange(window + 1) / window)
    scale = max(float(histogram.max()), 1.0)
    target = histogram / scale * weight
    uses = np.zeros((0, window + 1))
    chosen: list[int] = []
    x = np.zeros(0)
    for _ in range(rounds):
        rest = (target - x @ uses) * weight
        rest[0] = 0.0
        gain = rest[combos].sum(axis=1)
        gain[chosen] = 0.0
        taken: set[int] = set()
        fresh = []
        best = np.argpartition(-gain, min(8 * tries, len(gain) - 1))[:8 * tries]
        for c in best[np.argsort(-gain[best], kind="stable")]:
            lengths = {int(v) for v in combos[c] if v}
            if gain[c] > 1e-7 and not lengths & taken:
                fresh.append(int(c))
                taken |= lengths
                if len(fresh) == tries:
                    break
        if not fresh:
            break
        rows = np.zeros((len(fresh), window + 1))
        for i, c in enumerate(fresh):
            for v in combos[c]:
                if v:
                    rows[i, v] += weight[v]
        chosen += fresh
        uses, x = np.vstack([uses, rows]), np.append(x, np.zeros(len(fresh)))
        for _ in range(3):
            gram = uses @ uses.T
            gram[np.diag_indices_from(gram)] += 1e-9
            z = np.linalg.solve(gram, uses @ target)
            if (z > 0).all():
                x = z
                break
            down = z <= 0
            step = float(np.min(np.where(down, x / np.maximum(x - z, 1e-300), 1.0)))
            x = x + step * (z - x)
            stay = ~(down & (x <= 1e-12)) & ~(down & (z < -1e-3 * np.abs(z).max()))
            chosen, uses, x = [c for c, s in zip(chosen, stay, strict=True) if s], uses[stay], np.maximum(x[stay], 0.0)
    repeats = np.zeros(len(combos))
    repeats[chosen] = x * scale
    return repeats


def make_plan(counts: dict[int, int], window: int = WINDOW) -> Plan:
    """A plan that uses every piece of the histogram exactly once; its work depends on the window only."""
    histogram = np.zeros(window + 1, dtype=np.int64)
    for length, n in counts.items():
        histogram[length] = n
    plan = Plan([], [])
    if histogram[window]:
        plan.combinations.append((window,))
        plan.repeats.append(int(histogram[window]))
        histogram[window] = 0
    if histogram.any() and window >= 3:
        combos = shallow_combinations(window)
        repeats = np.rint(solve_repeats(combos, histogram.astype(float))).astype(np.int64)
        for c in np.argsort(-repeats, kind="stable"):
            if repeats[c] <= 0:
                break
            lengths = tuple(int(v) for v in combos[c] if v)
            each = {v: lengths.count(v) for v in lengths}
            n = min(int(repeats[c]), *(int(histogram[v]) // m for v, m in each.items()))
            if n > 0:  # rounding up may ask for more than there is
                plan.combinations.append(lengths)
                plan.repeats.append(n)
                for v, m in each.items():
                    histogram[v] -= n * m
    for lengths, n in _best_fit(histogram, window):
        plan.combinations.append(lengths)
        plan.repeats.append(n)
    return plan


def _best_fit(histogram: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Pack what is left, longest first, each into the tightest open sequences; like ones move together."""
    bins: dict[int, list[list]] = {}  # free space: [lengths, how many such sequences]
    for length in range(window, 0, -1):
        left = int(histogram[length])
        while left:
            space = min((s for s in bins if s >= length), default=None)
            if space is None:
                fit = window // length
                for lengths, n in (((length,) * fit, left // fit), ((length,) * (left % fit), 1)):
                    if lengths and n:
                        bins.setdefault(window - length * len(lengths), []).append([lengths, n])
                break
            group = bins[space][-1]
            n = min(left, group[1])
            bins.setdefault(space - length, []).append([(*group[0], length), n])
            group[1] -= n
            left -= n
            if not group[1]:
                bins[space].remove(group)
            if not bins[space]:
                del bins[space]
    return [(tuple(lengths), n) for space in sorted(bins) for lengths, n in bins[space]]


def pack(documents: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID,
         file: str | None = None, carry_ids: bool = False) -> DataFrame:
    """:func:`pieces` with ``sequence_id`` and ``offset`` (long): each sequence holds ``window`` ids at most.

    Only the histogram of lengths, ``window`` rows, comes to the driver; the plan made from it goes
    back as arrays of a size that the window bounds. A piece finds its place from its rank among
    all pieces of its length: the rank in its task, and the counts of earlier tasks.

    A NULL or empty text is ``end_id`` alone; NULL keys and repeated rows are packed like others; an
    empty table gives an empty result; long documents are cut into windows. Other columns are not carried.
    """
    spark = documents.sparkSession
    found = settled(pieces(documents, key, text, window, end_id, file, carry_ids))
    per_task = found.groupBy("__part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(make_plan(counts, window).places())
    before = per_task.select("__part", "length", F.coalesce(
        F.sum("n").over(Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("__before"))
    ranked = found.join(before, ["__part", "length"]).withColumn("__place", F.col("__before") + F.col("__rank"))
    names = [f"`{key}`", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if carry_ids else [])]
    slim = ranked.select(*names, "__place")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.drop("__place").schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.num_columns - 1).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for v in np.unique(length):
                at = length == v
                first, base, inside = places[int(v)]
                run = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at], offset[at] = base[run] + rank[at] - first[run], inside[run]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    return slim.mapInArrow(place, fields + ", sequence_id long, offset long")


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = END_ID) -> DataFrame:
    """``sequence_id`` and its ``input_ids``, padded to the window, from pieces that carry their ids."""
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p")).select(
        "sequence_id", F.flatten(F.col("p.ids")).alias("i")).select(
        "sequence_id", F.concat("i", F.array_repeat(F.lit(pad_id), F.lit(window) - F.size("i"))).alias("input_ids"))


def packing_query(documents: DataFrame) -> DataFrame:
    return pack(documents.select("doc_id", "text")).select(
        "doc_id", "start", F.col("length").cast("long"), "ids_crc32", "doc_tokens", "sequence_id", "offset")
