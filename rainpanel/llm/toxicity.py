"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainpanel.llm.common import give_back, settled

#: Labelled documents that may become examples, chosen by a hash of their id: the documented bound.
MAX_EXAMPLES = 10_000
NEIGHBOURS = 25
#: Examples of a block.
BLOCK = 4096
#: More than sums of single-precision weights are wrong by.
MARGIN = 1e-5
#: Longest lists that are kept as rows of a matrix, at most.
ROWS = 512
CUT = 0.7
#: Longer words also count by their first letters.
PREFIX = 7
#: What a term without telling power keeps of its weight.
FLOOR = 0.1
#: Added to a neighbour's distance before its vote is divided by it, so a copy outweighs a crowd.
NEARNESS = 0.01
#: What the votes of neighbours must outweigh.
DOUBT = 0.5
#: Bytes of text that are split at once.
SPLIT = 3_000_000


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different lower-case words (runs of letters) of the texts, and the word and text of each occurrence."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}]+")
    coded = lists.flatten().dictionary_encode()
    word, owner = coded.indices.to_numpy(zero_copy_only=False), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    real = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)[word]
    return coded.dictionary, word[real], owner[real]


def stems_of(words: pa.Array) -> pa.Array:
    """The first letters of longer words, marked with ``*``; NULL for the others."""
    stems = pc.binary_join_element_wise(pc.utf8_slice_codeunits(words, 0, PREFIX), "*", "")
    return pc.if_else(pc.greater(pc.utf8_length(words), PREFIX), stems, pa.scalar(None, pa.string()))


def counted_terms(texts: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term number and count of every term (of the sorted-out list ``terms``) in every text, in this order."""
    words, word, owner = words_of(texts)
    if not len(terms) or not len(word):
        return (np.zeros(0, dtype=np.int64),) * 3
    # One search for words and stems: each makes a table of all terms first.
    known = pc.fill_null(pc.index_in(pa.concat_arrays([words, stems_of(words)]), value_set=terms, skip_nulls=True), -1)
    numbers = []
    for part in np.split(known.to_numpy(zero_copy_only=False), 2):
        found = part[word]
        numbers.append(owner[found >= 0].astype(np.int64) * len(terms) + found[found >= 0])
    keys, counts = np.unique(np.concatenate(numbers), return_counts=True)
    return keys // len(terms), keys % len(terms), counts


def parts_of(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """The texts of a batch, a bounded number of bytes at a time, with the place of the first."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.unique(np.append(np.nonzero(np.diff(ends // SPLIT, prepend=0))[0], [0, len(texts)]))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield a, texts.slice(a, b - a)


class BlockMaxIndex:
    """Inverted lists over example vectors, cut into blocks of examples that know each term's largest weight.

    Lists of the commonest terms hold nearly every example, so they are kept as rows of a matrix that
    are added up whole (:meth:`common`). The k-th best of these sums is a floor: a
    query adds up the largest possible score of each block and reads only the parts of the other lists
    that lie in blocks which can reach it, so the result is that of comparing with every vector.
    """

    def __init__(self, example: np.ndarray, term: np.ndarray, weight: np.ndarray, size: int, n_terms: int, block: int = BLOCK):
        """``example`` is in order; weights are above 0."""
        self.block, self.size, self.blocks = block, size, max(1, -(-size // block))
        lengths = np.bincount(term, minlength=n_terms)
        longest = np.argsort(-lengths, kind="stable")[:ROWS]
        longest = longest[lengths[longest] > size / 8]
        self.row = np.full(n_terms, -1, dtype=np.int32)
        self.row[longest] = np.arange(len(longest))
        self.matrix = np.zeros((len(longest), size), dtype=np.float32)
        row = self.row[term]
        self.matrix[row[row >= 0], example[row >= 0]] = weight[row >= 0]
        example, term, weight = (x[row < 0] for x in (example, term, weight))
        order = np.argsort(term, kind="stable")
        # Entries are an example and the bits of its weight. Lists are in order of term and block; ``ends`` cuts them.
        weight = weight[order].astype(np.float32)
        self.entries = np.stack([example[order].astype(np.int32), weight.view(np.int32)], axis=1)
        cell = term[order].astype(np.int64) * self.blocks + example[order] // block
        self.ends = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1)).astype(np.int32)
        self.most = np.zeros(n_terms * self.blocks, dtype=np.float32)
        held = np.nonzero(np.diff(self.ends))[0]
        if len(held):
            self.most[held] = np.maximum.reduceat(weight, self.ends[held])
        self.most = self.most.reshape(n_terms, self.blocks)

    def common(self, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What the commonest terms of a query add to the score of every vector."""
        total, part = np.zeros(self.size, dtype=np.float32), np.empty(self.size, dtype=np.float32)
        rows = self.row[term]
        # Row by row: a matrix product would wake threads that a worker's core is not shared with.
        for r, w in zip(rows[rows >= 0].tolist(), weight[rows >= 0].tolist(), strict=True):
            np.multiply(self.matrix[r], w, out=part)
            total += part
        return total

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the k best vectors; of equals, the lower number."""
        base = self.common(term, weight)
        rare = self.row[term] < 0
        term, weight = term[rare].astype(np.int64), weight[rare].astype(np.float32)
        bound = weight @ self.most[term]
        if self.size:
            bound += np.maximum.reduceat(base, np.arange(0, self.size, self.block))
        # Other terms only add, so the k-th best of the common ones is in reach of the true k-th best.
        least = float(np.partition(base, -k)[-k]) if self.size >= k else 0.0
        opened = np.nonzero(bound >= max(least - MARGIN, MARGIN))[0]
        if not len(opened):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        # Blocks that follow one another are one part of a list.
        run = np.split(opened, np.nonzero(np.diff(opened) > 1)[0] + 1)
        low, high = (np.array([r[e] for r in run]) for e in (0, -1))
        cell = term[:, None] * self.blocks
        start, end = self.ends[cell + low].ravel(), self.ends[cell + high + 1].ravel()
        some = end > start
        start, end = start[some], end[some]
        scores = base
        if len(start):
            entries = np.concatenate([self.entries[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)])
            value = entries.view(np.float32)[:, 1] * np.repeat(np.repeat(weight, len(run))[some], end - start)
            scores = base + np.bincount(entries[:, 0], value, self.size)
        inside = np.zeros(self.blocks, dtype=bool)
        inside[opened] = True
        if not inside.all():
            scores = np.where(np.repeat(inside, self.block)[:self.size], scores, 0)
        least = float(np.partition(scores, -k)[-k]) if self.size >= k else 0.0
        found = np.nonzero(scores >= max(least - MARGIN, MARGIN))[0]
        scores = np.round(scores[found].astype(float), 6)
        best = np.lexsort((found, -scores))[:k]
        return found[best], scores[best]


class Model:
    """What scoring needs, all of it bounded by the examples and their words.

    ``examples`` are (id, label, term numbers, counts) of the labelled texts; all their words and stems
    are terms. A term weighs more the rarer it is among all documents and the likelier its examples are
    toxic; none is left out.
    """

    def __init__(self, terms: pa.Array, weight: np.ndarray, examples: pa.Table, bare_rate: float, neighbours: int = NEIGHBOURS):
        self.terms, self.weight, self.bare_rate, self.neighbours = terms, weight, bare_rate, neighbours
        votes: dict[bytes, list] = {}
        columns = [examples.column(c).to_pylist() for c in ("doc_id", "toxic")]
        lists = [examples.column(c).combine_chunks() for c in ("terms", "counts")]
        for i, (doc, toxic) in enumerate(zip(*columns, strict=True)):
            term, count = (c[i].values.to_numpy(zero_copy_only=False) for c in lists)
            if len(term):
                vote = votes.setdefault(xxhash.xxh128_digest(term.tobytes() + count.tobytes()), [0, 0, doc, term, count])
                vote[0] += 1
                vote[1] += toxic
                vote[2] = min(vote[2], doc)
        # Like examples lie together: by their commonest word, which tells the language, then by the most telling term.
        vectors = sorted(votes.values(), key=lambda v: (int(v[3][np.argmin(weight[v[3]])]), int(v[3][np.argmax(weight[v[3]])]), v[2]))
        self.all, self.toxic, self.docs = (np.array([v[j] for v in vectors], dtype=np.int64) for j in range(3))
        self.ends = np.append(0, np.cumsum([len(v[3]) for v in vectors])).astype(np.int64)
        self.term, self.count = (np.concatenate([v[j] for v in vectors] or [[]]).astype(np.int32) for j in (3, 4))
        self.steps: tuple[list[float], list[float]] = ([0.0, 1.0], [0.0, 1.0])
        self._seen: dict = {}

    @cached_property
    def value(self) -> np.ndarray:
        """Unit vectors. They and the lists are made where they are first used, so never on the driver."""
        value = np.log(self.count, dtype=np.float64)
        value += 1
        value *= self.weight[self.term]
        sizes = np.diff(self.ends)
        example = np.repeat(np.arange(len(sizes)), sizes)
        value /= np.sqrt(np.bincount(example, value ** 2, len(sizes)))[example]
        return value.astype(np.float32)

    @cached_property
    def index(self) -> BlockMaxIndex:
        value = self.value
        give_back()
        example = np.repeat(np.arange(len(self.docs), dtype=np.int32), np.diff(self.ends))
        index = BlockMaxIndex(example, self.term, value, len(self.docs), len(self.terms))
        give_back()
        return index

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("value", "index", "_seen")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._seen: dict = {}

    def unit(self, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Weights of a text's terms, of length 1."""
        weight = (1 + np.log(count)) * self.weight[term]
        return weight / np.sqrt((weight ** 2).sum())

    def vote(self, term: np.ndarray, weight: np.ndarray, leave: tuple[int, int] | None = None) -> tuple[float, np.ndarray]:
        """Share of toxic votes of the neighbours, each by its cosine over its distance; ``leave``: a vector and one label of it to take out."""
        near, cosine = self.index.nearest(term, weight, self.neighbours)
        n, toxic = self.all[near].astype(float), self.toxic[near].astype(float)
        if leave is not None:
            own = near == leave[0]
            n[own] -= 1
            toxic[own] -= leave[1]
        pull = cosine / (np.maximum(1 - cosine, 0) + NEARNESS)
        return float((pull * toxic).sum() / ((pull * n).sum() + DOUBT)), near

    def calibrate(self, table: list[tuple[float, int, int]]) -> None:
        """Fit a rising step function to (vote, examples, toxic ones), by pooling adjacent violators."""
        pools: list[list[float]] = []
        for vote, n, toxic in sorted(table):
            pools.append([vote, vote, n, toxic])
            while len(pools) > 1 and pools[-2][3] * pools[-1][2] >= pools[-1][3] * pools[-2][2]:
                low, _, n2, t2 = pools[-2]
                pools[-2:] = [[low, pools[-1][1], n2 + pools[-1][2], t2 + pools[-1][3]]]
        if pools:
            rates = np.maximum.accumulate([(t + 0.5) / (n + 1) for _, _, n, t in pools])
            ends = [(x, r) for (low, high, _, _), r in zip(pools, rates, strict=True) for x in (low, high)]
            self.steps = [x for x, _ in ends], [float(r) for _, r in ends]

    def score(self, term: np.ndarray, count: np.ndarray) -> tuple[float, list[int], list[str]]:
        """Score, ids of the nearest examples, and the terms that weigh most."""
        if not len(term):
            return self.bare_rate, [], []
        key = xxhash.xxh128_digest(term.tobytes() + count.tobytes())
        if key not in self._seen:
            if len(self._seen) > 5_000:
                self._seen.clear()
            weight = self.unit(term, count)
            vote, near = self.vote(term, weight)
            score = float(np.interp(vote, *self.steps)) if len(near) else self.bare_rate
            heavy = term[np.argsort(-weight, kind="stable")[:8]]
            self._seen[key] = score, self.docs[near[:3]].tolist(), self.terms.take(pa.array(heavy)).to_pylist()
        return self._seen[key]

    def scores(self, texts: pa.Array) -> Iterator[tuple[float, list[int], list[str]]]:
        """:meth:`score` of every text of a batch, in order."""
        for _, part in parts_of(texts):
            owner, term, count = counted_terms(part, self.terms)
            ends = np.searchsorted(owner, np.arange(len(part) + 1))
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                yield self.score(term[a:b], count[a:b])


def learnable(doc_id):
    """Whether labels of this id may be learned from."""
    return F.crc32(doc_id.cast("string")) % 3 != 1


def example_texts(documents: DataFrame, labels: DataFrame, max_examples: int) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``max_examples`` labelled ids, the lowest by hash.

    Of repeated labels of an id, the larger counts; of repeated texts, the last in order.
    """
    chosen = (
        labels.filter(F.col("toxic").isNotNull() & learnable(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples))
    # The side sent to all executors holds max_examples rows of an id and a label at most.
    return documents.select("doc_id", "text").join(F.broadcast(settled(chosen)), "doc_id").groupBy("doc_id").agg(
        F.max(F.coalesce("text", F.lit(""))).alias("text"), F.first("toxic").alias("toxic"))


def _term_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Examples that hold each term, and toxic ones among them, added up for each batch."""
    for batch in batches:
        toxic = batch.column(2).to_numpy(zero_copy_only=False)
        for begin, part in parts_of(batch.column(1)):
            words, word, owner = words_of(part)
            names = pa.concat_arrays([words, pc.drop_null(stems_of(words))]).unique()
            owner, term, _ = counted_terms(part, names)
            n = np.bincount(term, minlength=len(names))
            bad = np.bincount(term, toxic[begin + owner], minlength=len(names)).astype(np.int64)
            held = np.nonzero(n)[0]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(held)), pa.array(n[held]), pa.array(bad[held])], names=["term", "n", "bad"])
    give_back()


def telling(n: np.ndarray, bad: np.ndarray, n_all: int, bad_all: int) -> np.ndarray:
    """How much likelier than chance an example with the term is toxic: the log of smoothed odds, none below 0."""
    share = bad_all / n_all
    return np.maximum(np.log((bad + share) / (n - bad + 1 - share)) - math.log(share / (1 - share)), 0.0)


Steps = tuple[list[float], list[float]]


def fit(documents: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES) -> tuple[Broadcast, Steps]:
    """A model from the labels whose id may be learned from, sent to all workers once, and its calibration.

    Examples are bounded by ``max_examples``; all their words are terms. Document frequencies are
    counted over all ``documents``. NULL ids and labels are left out. Without examples of both kinds,
    every score is the rate of an even guess.
    """
    spark = documents.sparkSession
    examples = settled(example_texts(documents, labels, max_examples))
    n, toxic = examples.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < toxic < n:
        none = pa.table({"doc_id": pa.array([], pa.int64()), "toxic": pa.array([], pa.int32()),
                         "terms": pa.array([], pa.list_(pa.int32())), "counts": pa.array([], pa.list_(pa.int32()))})
        model = Model(pa.array([], pa.string()), np.zeros(0), none, (toxic + 0.5) / (n + 1))
        return spark.sparkContext.broadcast(model), model.steps
    found = examples.mapInArrow(_term_labels, "term string, n long, bad long").groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad")).toArrow().sort_by("term")
    terms = found.column("term").combine_chunks()
    named = spark.sparkContext.broadcast(terms)  # the words of at most max_examples texts

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = np.zeros(len(named.value), dtype=np.int64), 0
        for batch in batches:
            rows += len(batch)
            for _, part in parts_of(batch.column(0)):
                held += np.bincount(counted_terms(part, named.value)[1], minlength=len(held))
        some = np.nonzero(held)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1).astype(np.int32)), pa.array(np.append(held[some], rows))], names=["term", "n"])
        give_back()

    counted = documents.select("text").mapInArrow(frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    number, held = (counted.column(c).to_numpy() for c in ("term", "n"))
    frequency = np.ones(len(terms))
    frequency[number[number >= 0]] = held[number >= 0]
    idf = np.log(max(int(held[number < 0].sum()), 1) / frequency) + 0.01
    label_counts = [found.column(c).to_numpy().astype(float) for c in ("n", "bad")]
    weight = np.maximum(idf, 0.01) * (FLOOR + telling(*label_counts, n, toxic))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, part in parts_of(batch.column(1)):
                owner, term, count = counted_terms(part, named.value)
                ends = pa.array(np.searchsorted(owner, np.arange(len(part) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, len(part)), batch.column(2).slice(begin, len(part)),
                    *(pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (term, count))],
                    names=["doc_id", "toxic", "terms", "counts"])
        give_back()

    table = examples.mapInArrow(vectors, "doc_id long, toxic int, terms array<int>, counts array<int>").toArrow()
    bare = pc.equal(pc.list_value_length(table.column("terms")), 0)
    empty = table.filter(bare)
    rate = ((pc.sum(empty.column("toxic")).as_py() or 0) + toxic / n) / (len(empty) + 1)
    named.destroy()
    model = Model(terms, weight, table.filter(pc.invert(bare)).sort_by("doc_id"), rate)
    shared = spark.sparkContext.broadcast(model)
    return shared, _calibrated(model, shared, spark)


def _calibrated(model: Model, shared: Broadcast, spark) -> Steps:
    """Each example's vote without its own label, worked out by tasks, then pooled to steps."""
    if not len(model.docs):
        return model.steps
    frame = spark.range(len(model.docs)).repartition(min(64, 1 + len(model.docs) // 250))

    def leave_one_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, found = shared.value, []
        for batch in batches:
            for i in batch.column(0).to_pylist():
                at = slice(m.ends[i], m.ends[i + 1])
                for label, n in ((1, m.toxic[i]), (0, m.all[i] - m.toxic[i])):
                    if n:
                        found.append((round(m.vote(m.term[at], m.value[at], (i, label))[0], 3), int(n), int(n) * label))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[j] for f in found], t) for j, t in enumerate((pa.float64(), pa.int64(), pa.int64()))], names=["v", "n", "y"])

    table = frame.mapInArrow(leave_one_out, "v double, n long, y long").groupBy("v").agg(F.sum("n"), F.sum("y"))
    model.calibrate([tuple(r) for r in table.collect()])
    return model.steps


def _ready(shared: Broadcast, steps: Steps) -> Model:
    """The model of a worker that scores: with its index, without the vectors that only fitting needs."""
    model = shared.value
    model.steps = steps
    if "term" in model.__dict__:
        model.index  # noqa: B018
        for name in ("value", "term", "count"):
            model.__dict__.pop(name, None)
        give_back()
    return model


def score_documents(documents: DataFrame, labels: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Columns ``keep`` of every row and a struct ``__tox`` of score, predicted, evidence ids and terms.

    Only the text counts. Texts without a word that some example holds, NULL, empty and blank ones
    among them, get the rate of such examples, or of all where there is none. Repeated rows score alike; an empty table gives an empty result.
    """
    tox = T.StructType([
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
        T.StructField("evidence_ids", T.ArrayType(T.LongType())), T.StructField("evidence_terms", T.ArrayType(T.StringType()))])
    keep = list(keep)
    schema = T.StructType([*(documents.schema[c] for c in keep), T.StructField("__tox", tox)])
    arrow = pa.struct([("score", pa.float64()), ("predicted", pa.int32()), ("evidence_ids", pa.list_(pa.int64())),
                       ("evidence_terms", pa.list_(pa.string()))])
    shared, steps = fit(documents, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _ready(shared, steps)
        for batch in batches:
            found = [{"score": score, "predicted": int(score >= CUT), "evidence_ids": ids, "evidence_terms": words}
                     for score, ids, words in m.scores(batch.column(batch.schema.get_field_index("text")))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(found, arrow)], names=[*keep, "__tox"])
        give_back()

    needed = list(dict.fromkeys([*keep, "text"]))
    return documents.select(*(f"`{c}`" for c in needed)).mapInArrow(run, schema)


def keep_harmless(documents: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with their own columns, whatever their names.

    The model's counts take one pass over the texts, the filter another, in which a row goes through
    one worker only; texts are not exchanged. NULL and empty texts stay, as harmless as examples without
    a word; an empty table gives an empty one.
    """
    shared, steps = fit(documents, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _ready(shared, steps)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            yield batch.filter(pa.array([score < CUT for score, _, _ in m.scores(texts)], pa.bool_()))
        give_back()

    return documents.mapInArrow(run, documents.schema)


def toxicity_query(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_documents(documents, labels, ["doc_id"])
    held_out = F.coalesce(~learnable(F.col("doc_id")), F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "__tox.*")
