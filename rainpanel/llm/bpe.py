"""Byte-level BPE: ranked merges folded over the bytes of distinct words, and decoding by concatenation.

Two forms of the fold give the same ids. :func:`native_ids` is a Spark higher-order function over an
array of byte ids with the ranks as literals. :class:`WordEncoder` is the same fold inside the tasks
that read the texts; :func:`encode` uses it, since the first form takes some forty times as long for
a word (figures in the README). Decoding is a Spark expression in either case.
"""

from __future__ import annotations

import base64
import heapq
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainpanel.llm.common import SPACE_IN_RUN, bind

RANKS = "byte_bpe_50k.tiktoken"
#: Different words, and different pieces of words, that a worker remembers the ids of, twice at most.
REMEMBERED = 250_000
#: Pieces of more bytes are merged with a heap instead of a scan.
LONG = 128


def load_ranks(content: bytes) -> dict[bytes, int]:
    """Byte strings and their ranks, which are also their ids."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


def read_file(path: str | None = None) -> bytes:
    """The rank file on the driver, whose size is that of a vocabulary."""
    with open(path or public_tokenizers.path(RANKS), "rb") as source:
        return source.read()


def fold_merges(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: of all neighbours, those of lowest rank merge first, the left one of equals."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    if len(piece) > LONG:
        return _fold_long(piece, ranks)
    none = 1 << 60
    parts = [piece[i:i + 1] for i in range(len(piece))]
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while pairs and (best := min(pairs)) < none:
        at = pairs.index(best)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1], none)
    return [ranks[p] for p in parts]


def _fold_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges in n log n steps: a heap of neighbours over a linked list."""
    n = len(piece)
    parts: list[bytes | None] = [piece[i:i + 1] for i in range(n)]
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list[tuple[int, int, bytes]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] >= 0:
            joined = parts[i] + parts[after[i]]
            if (rank := ranks.get(joined)) is not None:
                heapq.heappush(heap, (rank, i, joined))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else -1
        if j < 0 or parts[i] + parts[j] != joined:
            continue  # one of the two has merged with another since
        parts[i], parts[j] = joined, None
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [ranks[p] for p in parts if p is not None]


class WordEncoder:
    """Ids of whole texts, folding each different piece once while it is remembered.

    The pattern starts a new piece at every space that white space does not surround, so the pieces of
    a text are those of its space-separated chunks, each with the space before it. Texts with a space
    inside or at the end of a run of any white space are split by the pattern as a whole.
    """

    def __init__(self, content: bytes, pattern: str = public_tokenizers.PATTERN, remembered: int = REMEMBERED):
        self.ranks, self.pattern, self.remembered = load_ranks(content), regex.compile(pattern), remembered
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        # What was known before the last change of memory; what is met again comes back from there.
        self.known_before: dict[str, bytes] = {}
        self.pieces_before: dict[str, bytes] = {}

    def _learn(self, word: str) -> bytes:
        if len(self.known) >= self.remembered:
            self.known_before, self.known = self.known, {}
        if (found := self.known_before.get(word)) is None:
            pieces = self.pieces
            found = b"".join([pieces.get(p) or self._piece(p) for p in self.pattern.findall(word)])
        self.known[word] = found
        return found

    def _piece(self, piece: str) -> bytes:
        if len(self.pieces) >= self.remembered:
            self.pieces_before, self.pieces = self.pieces, {}
        if (found := self.pieces_before.get(piece)) is None:
            ids = fold_merges(piece.encode(), self.ranks)
            found = struct.pack(f"<{len(ids)}i", *ids)
        self.pieces[piece] = found
        return found

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids."""
        text, known = text or "", self.known
        if SPACE_IN_RUN.search(text):
            pieces = self.pieces
            return b"".join([pieces.get(p) or self._piece(p) for p in self.pattern.findall(text)])
        first, *rest = text.split(" ")
        chunks = [first, *(" " + c for c in rest)]
        return b"".join([known.get(c) or self._learn(c) for c in chunks])


_ENCODERS: dict[int, WordEncoder] = {}


def _encoder(content: bytes) -> WordEncoder:
    """One for each worker process and rank file: workers serve many tasks."""
    name = zlib.crc32(content)
    if name not in _ENCODERS:
        _ENCODERS[name] = WordEncoder(content)
    return _ENCODERS[name]


def encode(documents: DataFrame, text: str = "text", keep: list[str] | None = None, path: str | None = None) -> DataFrame:
    """``documents`` (or its columns ``keep``) and ``ids`` (array of int) of the whole text; no exchange.

    A NULL or empty text has no ids; texts of any length, words of any length and repeated rows are
    encoded whole; an empty table gives an empty result. No special tokens are added or recognised.
    A column of the table that is named ``ids`` is replaced.
    """
    columns = [c for c in (documents.columns if keep is None else keep) if c.lower() != "ids"]
    schema = T.StructType([*(documents.schema[c] for c in columns), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    shared = documents.sparkSession.sparkContext.broadcast(read_file(path))  # as large as a vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            found = [encoder.encode(t.as_py()) for t in batch.column(batch.schema.get_field_index(text))]
            ends = np.cumsum([0, *(len(f) // 4 for f in found)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in columns), ids], names=[*columns, "ids"])

    needed = list(dict.fromkeys([*columns, text]))
    return documents.select(*(f"`{c}`" for c in needed)).mapInArrow(run, schema)


def _literal(values: list, kind: str) -> Column:
    """A large array as one literal: the optimizer works the parsing out before the job starts."""
    return F.from_json(F.lit("[" + ",".join(map(str, values)) + "]"), kind)


def decode(ids: Column, content: bytes) -> Column:
    """The bytes of an array of ids: each one's piece, from a literal array, one after another."""
    ranks = load_ranks(content)
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    table = _literal([f'"{base64.b64encode(p).decode()}"' for p in pieces], "array<binary>")
    # array_join concatenates the bytes as they are; only its type says text.
    return F.array_join(F.transform(ids, lambda i: F.get(table, i).cast("string")), "").cast("binary")


def native_ids(word: Column, content: bytes) -> Column:
    """Ids of one piece (binary) by a Spark fold: every step merges the pair of lowest rank wherever it stands.

    The state is the array of ids; a pair's rank comes from two literal hash tables, as Spark looks a
    map literal up from end to end.
    """
    ranks = load_ranks(content)
    first, second = (_literal(t, "array<bigint>") for t in _pair_tables(ranks))
    none = 1 << 20

    def rank(a: Column, b: Column) -> Column:
        def look(key: Column) -> Column:
            def slots(h: Column) -> Column:
                x = F.get(first, h.bitwiseAND(_SLOTS - 1).cast("int"))
                y = F.get(second, F.shiftright(h, 20).bitwiseAND(_SLOTS - 1).cast("int"))
                return F.when(F.shiftright(x, 16) == key, x.bitwiseAND(65535)).when(
                    F.shiftright(y, 16) == key, y.bitwiseAND(65535)).otherwise(F.lit(none)).cast("int")
            return bind(F.xxhash64(key), slots)
        return bind(a.cast("bigint") * 65536 + b + (1 << 32), look)

    def step(state: Column, _: Column) -> Column:
        def merged(ids: Column) -> Column:
            pairs = F.transform(F.slice(ids, 1, F.size(ids) - 1), lambda a, i: rank(a, F.get(ids, i + 1)))

            def at_best(pairs: Column) -> Column:
                def apply(best: Column) -> Column:
                    # Of a run of equal pairs the first merges; the others follow in later steps.
                    def hit(i: Column) -> Column:
                        return F.coalesce((F.get(pairs, i) == best) & ~F.coalesce(F.get(pairs, i - 1) == best, F.lit(False)), F.lit(False))
                    new = F.filter(F.transform(ids, lambda x, i: F.when(hit(i), best).when(hit(i - 1), -1).otherwise(x)), lambda x: x >= 0)
                    return F.when(best == none, F.struct(ids.alias("ids"), F.lit(True).alias("done"))).otherwise(
                        bind(new, lambda n: F.struct(n.alias("ids"), (F.size(n) < 2).alias("done"))))
                return bind(F.array_min(pairs), apply)
            return bind(pairs, at_best)
        return F.when(state["done"], state).otherwise(merged(state["ids"]))

    alphabet = _literal([ranks[bytes([b])] for b in range(256)], "array<int>")
    n = F.octet_length(word)
    single = F.transform(
        F.filter(F.sequence(F.lit(0), n), lambda i: i < n),
        lambda i: F.get(alphabet, F.conv(F.hex(F.substring(word, i + 1, F.lit(1))), 16, 10).cast("int")))
    start = F.struct(single.alias("ids"), (n < 2).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), start, step, lambda s: s["ids"])


_SLOTS = 1 << 18


def _pair_tables(ranks: dict[bytes, int]) -> tuple[list[int], list[int]]:
    """Every pair of ids that may merge, with the merged id, where one of two hashes says (cuckoo hashing)."""
    tables = [0] * _SLOTS, [0] * _SLOTS

    def slot(key: int, which: int) -> int:
        return (xxhash.xxh64_intdigest(struct.pack("<q", key), 42) >> (20 * which)) & (_SLOTS - 1)

    for token, merged in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is None or right is None:
                continue
            item, which = ((left << 16 | right) + (1 << 32)) << 16 | merged, 0
            for _ in range(10_000):
                at = slot(item >> 16, which)
                tables[which][at], item = item, tables[which][at]
                if not item:
                    break
                which = 1 - which
            else:
                raise ValueError("the ranks do not fit the tables")
    return tables


def bpe_query(documents: DataFrame) -> DataFrame:
    encoded = encode(documents.select("doc_id", "text"), keep=["doc_id"])
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), read_file()), 256).alias("decoded_sha256"))
