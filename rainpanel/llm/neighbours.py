"""Approximate nearest neighbours: multiprobe p-stable hashing, then exact distances.

Every vector is hashed by several tables of p-stable functions, ``floor((a . x + b) / w)`` with normal
``a`` (Datar and others, 2004). A query visits its own bucket and the perturbed ones around it in the
order of their estimated success (Lv and others, "Multi-Probe LSH", 2007), and the candidates of all
tables are merged and ranked by their exact Euclidean distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rainpanel.llm.common import settled


@dataclass(frozen=True)
class Settings:
    """Size of the index. Its width and its probes are fitted on a bounded sample; every row is indexed."""

    tables: int = 4
    functions: int = 8  # of one table; at most 8, since a query scores all 3 ** functions perturbations
    width: float = 2.5  # first bucket width, in standard deviations of the sample's projections
    sample: int = 8_192  # vectors that the width is fitted on
    audit: int = 64  # queries whose true neighbours, among all rows, decide the number of probes
    recall: float = 0.96  # of those neighbours that the probes must reach
    shard: int = 4_096  # vectors that one unit of work holds, about

    def __post_init__(self):
        if not 1 <= self.functions <= 8:
            raise ValueError("functions must be 1 to 8")


_NEAR = pa.list_(pa.struct([("score", pa.float64()), ("first", pa.int64()), ("node", pa.int64())]))
_FOUND = "q long, near array<struct<score: double, first: long, node: long>>"


def valid_vector(x: Column) -> Column:
    """True for an array with only finite components, one of them not zero."""
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    return F.coalesce(x.isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))


class Family:
    """The hash tables, and the bucket numbers of vectors and of a query's probes."""

    def __init__(self, dim: int, s: Settings, width: float, probes: int):
        draw = np.random.default_rng(29)
        self.a = draw.normal(size=(s.tables, s.functions, dim))
        self.b = draw.uniform(size=(s.tables, s.functions))
        self.mix = draw.integers(1, 2 ** 62, size=(s.tables, s.functions), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.width, self.probes = width, probes

    def slots(self, x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each function, and how far into it the vector lies, from 0 to 1."""
        at = x @ self.a[table].T / self.width + self.b[table]
        slot = np.floor(at)
        return slot.astype(np.int64), at - slot

    def buckets(self, x: np.ndarray, table: int) -> np.ndarray:
        return (self.slots(x, table)[0].astype(np.uint64) * self.mix[table]).sum(axis=1, dtype=np.uint64)

    def scores(self, inside: np.ndarray) -> np.ndarray:
        """For each query, the score of every perturbation (no step, one down, one up, per function).

        It is the sum of squared distances to the borders crossed; the smaller, the likelier a success.
        """
        total = np.zeros((len(inside), 1))
        for i in range(inside.shape[1]):
            steps = np.stack([np.zeros(len(inside)), inside[:, i] ** 2, (1 - inside[:, i]) ** 2], axis=1)
            total = (total[:, :, None] + steps[:, None, :]).reshape(len(inside), -1)
        return total

    def probed(self, x: np.ndarray, table: int) -> np.ndarray:
        """Buckets to visit, in falling order of estimated success: a row for each query."""
        slot, inside = self.slots(x, table)
        shift = np.zeros(1, dtype=np.uint64)
        for step in self.mix[table].tolist():
            shift = (shift[:, None] + np.array([0, 2 ** 64 - step, step], dtype=np.uint64)[None]).ravel()
        score = self.scores(inside)
        most = min(self.probes, score.shape[1])
        best = np.argpartition(score, most - 1, axis=1)[:, :most]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(score, best, 1), axis=1, kind="stable"), 1)
        own = (slot.astype(np.uint64) * self.mix[table]).sum(axis=1, dtype=np.uint64)
        return own[:, None] + shift[best]

    def places(self, query: np.ndarray, near: np.ndarray) -> np.ndarray:
        """For pairs of vectors, the first probe of any table that reaches the neighbour (a large number: none)."""
        first = np.full(len(query), np.iinfo(np.int64).max)
        for table in range(len(self.a)):
            slot, inside = self.slots(query, table)
            step = self.slots(near, table)[0] - slot
            reached = (np.abs(step) <= 1).all(axis=1)
            code = np.zeros(len(query), dtype=np.int64)
            for i in range(step.shape[1]):
                code = code * 3 + np.where(step[:, i] == -1, 1, np.where(step[:, i] == 1, 2, 0))
            for j in np.nonzero(reached)[0]:
                score = self.scores(inside[j:j + 1])[0]
                first[j] = min(first[j], int((score < score[code[j]]).sum()))
        return first


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """``x``, ``ids`` (the ``k`` + 1 smallest of the vector's ids), ``first`` and ``node``, a row for each different vector.

    No more ids of one vector can be among anyone's ``k`` nearest. The window keeps its first rows
    before the exchange too, so copies, however many, send a few rows for each task.
    """
    order = Window.partitionBy("x").orderBy("id")
    few = rows.distinct().withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= k + 1)
    grouped = few.groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return settled(grouped.withColumn("first", F.get("ids", F.lit(0))).withColumn("node", F.monotonically_increasing_id()))


def _fit(nodes: DataFrame, asked: DataFrame, n: int, k: int, s: Settings) -> Family:
    """Width from the sample, number of probes from the true neighbours of the audit queries."""
    draw = F.xxhash64("node", F.lit(17))
    drawn = nodes.orderBy(draw, "node").limit(s.sample).select("x").toArrow()
    sample = _matrix(drawn.column(0).combine_chunks())
    trial = Family(sample.shape[1], s, 1.0, 1)
    spread = float(np.mean([(sample @ a.T).std(axis=0).mean() for a in trial.a]))
    width = s.width * spread if spread > 0 else 1.0
    audit = settled(asked.orderBy(draw, "node").limit(s.audit))
    found = merged(search(nodes, everywhere(audit, n, s), n, s, None, k), k)
    pairs = found.select("q", F.explode("near").alias("p")).filter("p.node <> q").select("q", "p.node")
    left, right = audit.select(F.col("node").alias("q"), F.col("x").alias("a")), nodes.select("node", F.col("x").alias("b"))
    both = pairs.join(left, "q").join(right, "node").select("a", "b").toArrow()
    if not len(both):
        return Family(sample.shape[1], s, width, 1)
    a, b = (_matrix(both.column(c).combine_chunks()) for c in ("a", "b"))
    need = int(np.ceil(s.recall * len(a))) - 1
    while True:
        place = np.sort(Family(sample.shape[1], s, width, 1).places(a, b))[need]
        if place < 3 ** s.functions:
            return Family(sample.shape[1], s, width, int(place) + 1)
        width *= 1.5  # too narrow: neighbours lie more than one slot away


def _n_shards(n: int, s: Settings) -> int:
    return max(1, -(-n // s.shard))


def _hashed(nodes: DataFrame, family: Family | None, n_shards: int, with_vectors: bool) -> DataFrame:
    """Each vector once for each table, with its bucket and shard; without a family, once, in a shard by its number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2))
            for table in range(len(family.a) if family else 1):
                bucket = family.buckets(x, table) if family else batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                shard = (bucket >> np.uint64(16)) % np.uint64(n_shards)
                columns = [pa.array(np.full(len(x), table, dtype=np.int32)), pa.array(shard.astype(np.int32)), batch.column(0)]
                if with_vectors:
                    columns += [batch.column(1), pa.array(bucket.view(np.int64)), batch.column(2)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    item = nodes.schema["x"].dataType.elementType.simpleString()
    schema = "table int, shard int, node long" + (f", first long, bucket long, x array<{item}>" if with_vectors else "")
    names = [c.split()[0] for c in schema.split(", ")]
    return nodes.select("node", "first", "x").mapInArrow(run, schema)


def probes(asked: DataFrame, family: Family, n: int, s: Settings) -> DataFrame:
    """``table, shard, q, x, probes``: the buckets that a query visits, a row for each shard that holds some."""
    n_shards = _n_shards(n, s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), 256):
                batch = whole.slice(begin, 256)
                x = _matrix(batch.column(1))
                for table in range(len(family.a)):
                    keys = family.probed(x, table)
                    row = np.repeat(np.arange(len(x)), keys.shape[1])
                    keys = keys.ravel()
                    shard = ((keys >> np.uint64(16)) % np.uint64(n_shards)).astype(np.int32)
                    order = np.lexsort((shard, row))
                    row, shard, keys = row[order], shard[order], keys[order]
                    start = np.nonzero(np.append(True, (row[1:] != row[:-1]) | (shard[1:] != shard[:-1])))[0]
                    lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(keys)).astype(np.int32)), pa.array(keys.view(np.int64)))
                    at = pa.array(row[start])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(start), table, dtype=np.int32)), pa.array(shard[start]), batch.column(0).take(at),
                         batch.column(1).take(at), lists], names=["table", "shard", "q", "x", "probes"])

    item = asked.schema["x"].dataType.elementType.simpleString()
    return asked.select("node", "x").mapInArrow(run, f"table int, shard int, q long, x array<{item}>, probes array<long>")


def everywhere(asked: DataFrame, n: int, s: Settings) -> DataFrame:
    """Like :func:`probes`, for queries that are compared with every row."""
    shards = F.sequence(F.lit(0), F.lit(_n_shards(n, s) - 1))
    return asked.select(F.lit(0).alias("table"), F.explode(shards).alias("shard"), F.col("node").alias("q"), "x",
                        F.lit(None).cast("array<long>").alias("probes"))


def search(nodes: DataFrame, probed: DataFrame, n: int, s: Settings, family: Family | None, k: int) -> DataFrame:
    """``q, near``: for each unit of work that a query visits, its ``k`` + 1 nearest vectors there.

    A unit is a part of a shard with about ``s.shard`` vectors: a shard that a crowded bucket makes
    larger is cut by the vectors' numbers, and its queries visit every part. A partition is sorted so
    that a unit's vectors come before its queries; the vectors are held and the queries stream by.
    """
    n_shards = _n_shards(n, s)
    sizes = _hashed(nodes, family, n_shards, False).groupBy("table", "shard").agg(F.count(F.lit(1)).alias("n"))
    parts = settled(sizes.select("table", "shard", F.ceil(F.col("n") / (1.5 * s.shard)).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    members = _hashed(nodes, family, n_shards, True).join(parts, ["table", "shard"]).select(
        "table", "shard", part.alias("part"), F.lit(0).alias("kind"), "node", "first", "bucket",
        F.lit(None).cast("array<long>").alias("probes"), "x")
    asking = probed.join(parts, ["table", "shard"]).select(
        "table", "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("kind"),
        F.col("q").alias("node"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("bucket"), "probes", "x")
    unit = ("table", "shard", "part")
    sorted_ = members.unionByName(asking).repartition(*unit).sortWithinPartitions(*unit, "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(4)], axis=1)
            cuts = [0, *(np.nonzero((keys[1:] != keys[:-1]).any(axis=1))[0] + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                key, slice_ = tuple(keys[a]), batch.slice(a, b - a)
                if key[:3] != now:
                    now, held = key[:3], []
                if key[3] == 0:
                    held.append(slice_)
                elif held:
                    if not isinstance(held, _Unit):
                        held = _Unit(held)
                    for begin in range(0, b - a, 256):
                        yield held.nearest(slice_.slice(begin, 256), k)

    return sorted_.mapInArrow(run, _FOUND)


class _Unit:
    """The vectors of one unit of work."""

    def __init__(self, batches: list[pa.RecordBatch]):
        whole = pa.Table.from_batches(batches)
        self.x = np.concatenate([_matrix(b.column(8)) for b in batches])
        self.node, self.first = whole.column(4).to_numpy(), whole.column(5).to_numpy()
        self.buckets, self.own = np.unique(whole.column(6).to_numpy(), return_inverse=True)
        self.square = (self.x ** 2).sum(axis=1)

    def _open(self, lists: pa.ListArray) -> np.ndarray | None:
        """Which vectors each query may see, by its probed buckets; None: all."""
        if lists.null_count:
            return None
        key = lists.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        at = np.minimum(np.searchsorted(self.buckets, key), len(self.buckets) - 1)
        hit = self.buckets[at] == key
        seen = np.zeros((len(lists), len(self.buckets)), dtype=bool)
        seen[row[hit], at[hit]] = True
        return seen[:, self.own]

    def nearest(self, asking: pa.RecordBatch, k: int) -> pa.RecordBatch:
        q = _matrix(asking.column(8))
        rough = (q ** 2).sum(axis=1)[:, None] + self.square[None] - 2 * q @ self.x.T
        error = 1e-12 * (1 + self.square.max() + (q ** 2).sum(axis=1))  # what rounding can make of a squared distance
        if (seen := self._open(asking.column(7))) is not None:
            rough[~seen] = np.inf
        most = min(k + 1, len(self.x))
        bound = np.partition(rough, most - 1, axis=1)[:, most - 1] + 2 * error
        result = []
        for i, row in enumerate(rough):
            at = np.nonzero((row <= bound[i]) & np.isfinite(row))[0]
            exact = np.sqrt(((self.x[at] - q[i]) ** 2).sum(axis=1))
            best = np.lexsort((self.first[at], exact))[:most]
            result.append([{"score": float(exact[j]), "first": int(self.first[at[j]]), "node": int(self.node[at[j]])} for j in best])
        return pa.RecordBatch.from_arrays([asking.column(4), pa.array(result, _NEAR)], names=["q", "near"])


def merged(found: DataFrame, k: int) -> DataFrame:
    """``q, near``: the ``k`` + 1 nearest of all units, in two steps, so that no group holds the lists of all of them."""
    def best(column: str) -> Column:
        return F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(column)))), 1, k + 1).alias("near")

    some = found.withColumn("__salt", F.pmod(F.xxhash64("near"), F.lit(16))).groupBy("q", "__salt").agg(best("near"))
    return some.groupBy("q").agg(best("near"))


def nearest_neighbours(
    vectors: DataFrame, asked: Column, k: int = 10, id_col: str = "vec_id", vector: str = "embedding", s: Settings = Settings(),
) -> DataFrame:
    """``query_id, rank, <id_col>, score``: the ``k`` nearest found of every row for which ``asked`` is true.

    Nearness is the Euclidean distance in double precision on the original components; ties go to the
    smaller id. All rows are indexed and are candidates but the query's own id; all candidates are
    returned where there are no more than ``k``. Equal vectors are searched once. A query whose probes
    reach fewer than ``k`` others is compared with every row instead.

    Vectors that are NULL, empty, all zero or that hold NULL or non-finite components take no part, nor
    do rows without an id, nor vectors of another length than the most common one (the longer on a
    tie). Repeated rows count once; of an id's different vectors each is compared and the nearest
    counts. Other columns are not looked at. An empty table, or one without queries, gives an empty
    result.
    """
    x = F.col(f"`{vector}`")
    rows = vectors.filter(F.col(f"`{id_col}`").isNotNull() & valid_vector(x)).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), x.alias("x"), F.coalesce(asked, F.lit(False)).alias("asked"))
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    spark, schema = vectors.sparkSession, T.StructType([
        T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField(id_col, T.LongType()),
        T.StructField("score", T.DoubleType())])
    if common is None:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("x") == common["d"])
    nodes = distinct_vectors(rows.select("id", "x"), k)
    n = nodes.count()
    queries = settled(rows.filter("asked").select("id", "x").distinct().join(nodes.select("x", "node"), "x").select("id", F.col("node").alias("q")))
    wanted = settled(nodes.join(queries.select(F.col("q").alias("node")).distinct(), "node", "left_semi").select("node", "first", "x"))
    if wanted.isEmpty():
        return spark.createDataFrame([], schema)
    family = _fit(nodes, wanted, n, k, s)
    found = settled(merged(search(nodes, probes(wanted, family, n, s), n, s, family, k), k))
    enough = F.size("near") >= min(k + 1, n)
    short = settled(wanted.join(found.filter(enough).select(F.col("q").alias("node")), "node", "left_anti"))
    if not short.isEmpty():
        whole = merged(search(nodes, everywhere(short, n, s), n, s, None, k), k)
        found = settled(found.filter(enough).unionByName(whole))
    pairs = found.select("q", F.explode("near").alias("p")).select("q", "p.score", "p.node")
    named = pairs.join(nodes.select("node", "ids"), "node").select("q", "score", F.explode("ids").alias("id"))
    lists = named.groupBy("q", "id").agg(F.min("score").alias("score")).groupBy("q").agg(
        F.array_sort(F.collect_list(F.struct("score", "id"))).alias("near"))
    others = F.slice(F.filter("near", lambda p: p["id"] != F.col("query_id")), 1, k)
    # Repeated ids with different vectors make several lists; the nearest of each candidate counts.
    answered = queries.withColumnRenamed("id", "query_id").join(lists, "q").select("query_id", F.explode(others).alias("p"))
    single = answered.groupBy("query_id", "p.id").agg(F.min("p.score").alias("score"))
    ranked = single.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


def neighbours_query(embeddings: DataFrame) -> DataFrame:
    return nearest_neighbours(embeddings, F.col("vec_id") % 100 == 0)
