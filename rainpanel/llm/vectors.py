"""Near-duplicate vectors through a robust-pruned flat graph on overlapping cluster shards."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainpanel.llm.common import settled
from rainpanel.llm.components import component_roots


@dataclass(frozen=True)
class Settings:
    """Bounds of the index. A shard is one task's work; a sample fits one group's centres."""

    similarity: float = 0.98
    shard: int = 1_500  # vectors that a shard aims at
    most: int = 3_000  # a larger shard is split again
    children: int = 128  # most centres of one split
    sample: int = 8_192  # vectors of a shard that its centres are fitted on, about, by hash
    overlap: int = 2  # shards that a vector joins: its nearest centres
    degree: int = 20  # neighbours a node keeps
    beam: int = 24  # open nodes of a greedy search
    alpha: float = 1.2  # robust pruning: how much nearer a kept neighbour must be to cover another
    slack: float = 0.03  # range search expands nodes this far below the similarity
    audit: int = 200  # vectors of a label, at least, compared with all of it, to measure recall
    audit_root: float = 4.0  # and so many times the square root of the label's rows
    recall: float = 0.95  # below it, a label's index is built again, wider; at last all its pairs are compared
    block: int = 4_096  # vectors of a block, where blocks are compared with blocks


# ---- the graph of one shard -------------------------------------------------------------------


def robust_prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours of each node in falling similarity, without those that a nearer kept one covers.

    ``candidates`` has a row for each node, -1 filled; so has the result, ``degree`` wide. The nearest
    64 candidates are looked at.
    """
    result = np.full((len(nodes), degree), -1, dtype=np.int32)
    for begin in range(0, len(nodes), 256):
        node, found = nodes[begin:begin + 256], np.sort(candidates[begin:begin + 256], axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        found[found == node[:, None]] = -1
        near = np.einsum("ijk,ik->ij", x[np.maximum(found, 0)], x[node])
        near[found < 0] = -np.inf
        order = np.argsort(-near, axis=1, kind="stable")[:, :64]
        found, near = np.take_along_axis(found, order, 1), np.take_along_axis(near, order, 1)
        each = x[np.maximum(found, 0)]
        between = np.sqrt(np.maximum(2 - 2 * (each @ each.transpose(0, 2, 1)), 0.0))
        far = np.sqrt(np.maximum(2 - 2 * near, 0.0))
        alive, count = found >= 0, np.zeros(len(node), dtype=np.int64)
        for i in range(found.shape[1]):
            pick = np.nonzero(alive[:, i] & (count < degree))[0]
            result[begin + pick, count[pick]] = found[pick, i]
            count[pick] += 1
            alive[pick] &= alpha * between[pick, i] > far[pick]
    return result


def greedy_search(x: np.ndarray, graph: np.ndarray, starts: np.ndarray, queries: np.ndarray, beam: int) -> np.ndarray:
    """For each query, the ids that a best-first walk from ``starts`` keeps open (rows of ``beam``, -1 for none).

    All queries take one step together. ``graph`` has a row of neighbours for every node, -1 filled.
    """
    n, rows = len(queries), np.arange(len(queries))
    ids = np.full((n, beam), -1, dtype=np.int32)
    near = np.full((n, beam), -np.inf)
    open_ = np.zeros((n, beam), dtype=bool)
    first = len(starts)
    ids[:, :first], near[:, :first], open_[:, :first] = starts, queries @ x[starts].T, True
    for _ in range(4 * beam):
        at = np.argmax(np.where(open_, near, -np.inf), axis=1)
        live = open_[rows, at]
        if not live.any():
            break
        who = rows[live]
        open_[who, at[live]] = False
        new = graph[ids[who, at[live]]]
        known = (new[:, :, None] == ids[who][:, None, :]).any(axis=2) | (new < 0)
        score = np.where(known, -np.inf, np.einsum("ijk,ik->ij", x[np.maximum(new, 0)], queries[who]))
        every = np.concatenate([near[who], score], axis=1)
        best = np.argsort(-every, axis=1, kind="stable")[:, :beam]
        both = np.concatenate([ids[who], np.where(known, -1, new)], axis=1)
        still = np.concatenate([open_[who], ~known], axis=1)
        ids[who], near[who] = np.take_along_axis(both, best, 1), np.take_along_axis(every, best, 1)
        open_[who] = np.take_along_axis(still, best, 1) & (ids[who] >= 0)
    return ids


def medoids(x: np.ndarray, most: int = 8) -> np.ndarray:
    """The most central vector of the shard and of a few groups of it."""
    pivots = x[np.random.default_rng(len(x)).choice(len(x), min(most - 1, len(x)), replace=False)]
    own = np.argmax(x @ pivots.T, axis=1)
    groups = [np.arange(len(x)), *(np.nonzero(own == k)[0] for k in range(len(pivots)))]
    return np.unique([g[int(np.argmax(x[g] @ x[g].mean(axis=0)))] for g in groups if len(g)])


def build_graph(x: np.ndarray, s: Settings) -> np.ndarray:
    """Insert nodes in doubling batches: search, prune, link back, and prune what grew too long."""
    n = len(x)
    graph = np.full((n, s.degree), -1, dtype=np.int32)
    if n < 2:
        return graph
    starts = medoids(x)
    rest = np.random.default_rng(n).permutation(n)
    order = np.concatenate([starts, rest[~np.isin(rest, starts)]])
    graph[starts] = robust_prune(x, starts, np.tile(starts, (len(starts), 1)).astype(np.int32), s.degree, s.alpha)
    done = len(starts)
    while done < n:
        batch = order[done:done + max(1, min(done, 512))]
        seen = greedy_search(x, graph, starts, x[batch], s.beam)
        graph[batch] = robust_prune(x, batch, seen, s.degree, s.alpha)
        row, col = np.nonzero(graph[batch] >= 0)
        _link_back(x, graph, graph[batch][row, col], batch[row], s)
        done += len(batch)
    return graph


def _link_back(x: np.ndarray, graph: np.ndarray, to: np.ndarray, new: np.ndarray, s: Settings) -> None:
    """Add ``new`` nodes to the lists of ``to``; lists that grow too long are pruned."""
    by = np.argsort(to, kind="stable")
    nodes, first, count = np.unique(to[by], return_index=True, return_counts=True)
    more = np.full((len(nodes), count.max(initial=0)), -1, dtype=np.int32)
    more[np.repeat(np.arange(len(nodes)), count), np.arange(len(to)) - np.repeat(first, count)] = new[by]
    wide = np.concatenate([graph[nodes], more], axis=1)
    fits = (wide >= 0).sum(axis=1) <= s.degree
    packed = np.take_along_axis(wide, np.argsort(wide < 0, axis=1, kind="stable"), 1)
    graph[nodes[fits]] = packed[fits][:, :s.degree]
    graph[nodes[~fits]] = robust_prune(x, nodes[~fits], wide[~fits], s.degree, s.alpha)


def range_search(x: np.ndarray, lists: list[np.ndarray], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i < j) found at the similarity or more, by walking on from every node in range.

    A greedy walk from the medoids, over the first neighbours of each list, reaches each query's
    neighbourhood; from there every node within the slack of the range is expanded, over its whole
    list, until no new one turns up. Pairs are verified in double precision.
    """
    n, width = len(x), 2 * s.degree
    graph = np.full((n, width), -1, dtype=np.int32)
    for i, found in enumerate(lists):
        graph[i, :min(width, len(found))] = found[:width]
    degree = np.array([len(found) for found in lists])
    first_of, flat = np.r_[0, np.cumsum(degree)], np.concatenate(lists).astype(np.int64)
    left, right = [], []
    starts = medoids(x)
    reached = np.concatenate([greedy_search(x, graph, starts, x[at:at + 512], s.beam) for at in range(0, n, 512)])
    for begin in range(0, n, 64):
        q = np.arange(begin, min(n, begin + 64))
        ids = reached[q]
        row, col = np.nonzero(ids >= 0)
        first = np.concatenate([row.astype(np.int64) * n + ids[row, col], np.arange(len(q)) * n + q])
        frontier = np.unique(first)
        seen = frontier
        while len(frontier):
            who, node = frontier // n, frontier % n
            near = np.einsum("ij,ij->i", x[q[who]], x[node])
            hit = near >= s.similarity
            left.append(q[who[hit]])
            right.append(node[hit])
            grow = near >= s.similarity - s.slack
            count = degree[node[grow]]
            inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            new = flat[np.repeat(first_of[node[grow]], count) + inside]
            frontier = np.setdiff1d(np.unique(np.repeat(who[grow], count) * n + new), seen, assume_unique=True)
            seen = np.union1d(seen, frontier)
    a, b = np.concatenate(left), np.concatenate(right)
    keep = a != b
    return np.divmod(np.unique(np.minimum(a, b)[keep] * n + np.maximum(a, b)[keep]), n)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position reachable in a shard."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    return root


# ---- cluster shards ---------------------------------------------------------------------------


def usable(vector: Column, label: Column) -> Column:
    """Whether a row may link: it has a label, and finite components that are not all zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(frame: pd.DataFrame) -> np.ndarray:
    return np.array(frame["x"].tolist(), dtype=np.float64)


def _centres(sample: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means, started from points far apart."""
    rng = np.random.default_rng(5)
    centres = sample[[int(rng.integers(len(sample)))]]
    for _ in range(k - 1):
        far = (sample @ centres.T).max(axis=1)
        centres = np.vstack([centres, sample[int(np.argmin(far + rng.random(len(far)) * 0.2))]])
    for _ in range(8):
        own = np.argmax(sample @ centres.T, axis=1)
        for j in range(len(centres)):
            if (own == j).any():
                mean = sample[own == j].sum(axis=0)
                centres[j] = mean / max(float(np.linalg.norm(mean)), 1e-12)
    return centres


def _principal_cuts(sample: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A direction and the values that cut the sample into ``k`` equal parts along it."""
    middle = sample.mean(axis=0)
    direction = np.linalg.svd(sample[:512] - middle, full_matrices=False)[2][0]
    return direction, np.quantile(sample @ direction, np.arange(1, k) / k)


def _fit_split(sample: np.ndarray, size: int, s: Settings) -> tuple[np.ndarray, list[float] | None]:
    """Centres, or one direction with cuts where the centres do not tell the vectors apart (near copies)."""
    k = int(min(s.children, max(s.overlap + 2, -(-size * s.overlap // s.shard))))
    centres = _centres(sample, k)
    own = np.argsort(-(sample @ centres.T), axis=1)[:, :s.overlap]
    if np.bincount(own.ravel(), minlength=k).max() <= 0.75 * len(sample):
        return centres, None
    direction, cuts = _principal_cuts(sample, k)
    return direction[None, :], cuts.tolist()


def _children(x: np.ndarray, centres: np.ndarray, cuts, overlap: int) -> list[np.ndarray]:
    """The parts each vector joins: its nearest centres, or its stretch between cuts and the nearer next one."""
    along = x @ centres.T
    if cuts is None:
        return list(np.argsort(-along, axis=1, kind="stable")[:, :overlap].T)
    cuts = np.asarray(cuts)
    own = np.searchsorted(cuts, along[:, 0])
    low, high = np.r_[-np.inf, cuts][own], np.r_[cuts, np.inf][own]
    other = np.where(along[:, 0] - low < high - along[:, 0], own - 1, own + 1)
    return [own, np.clip(other, 0, len(cuts))]


def split_shards(nodes: DataFrame, s: Settings) -> DataFrame:
    """``nodes`` (``node``, ``x``, ``m``, ``shard``) with every shard over ``s.most`` split, again and again.

    Centres of a shard are fitted on a bounded sample of it and joined to its vectors by the shard's
    name; each vector goes on to its ``overlap`` nearest centres. Shards of near copies, which centres
    cannot tell apart, stay whole and are marked so (``whole``): all their pairs are compared.
    """
    nodes = nodes.withColumn("whole", F.lit(False))
    while True:
        large = settled(nodes.filter("not whole").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > s.most))
        if large.isEmpty():
            return nodes
        big = nodes.join(large, "shard")
        rate = F.lit(float(1 << 30) * s.sample) / F.col("n").cast("double")
        drawn = big.filter(F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 30)) < rate)

        def fit(key, frame: pd.DataFrame) -> pd.DataFrame:
            centres, cuts = _fit_split(_matrix(frame), int(frame["n"].iloc[0]), s)
            return pd.DataFrame({"shard": [key[0]], "centres": [[c.tolist() for c in centres]], "cuts": [cuts]})

        fitted = settled(drawn.select("shard", "n", "x").groupBy("shard").applyInPandas(
            fit, "shard string, centres array<array<double>>, cuts array<double>"))

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                frame = batch.to_pandas()
                new, source, whole = [], [], []
                for shard, part in frame.groupby("shard", sort=False):
                    if part["cuts"].iloc[0] is not None:
                        new += [shard] * len(part)
                        source += part.index.tolist()
                        whole += [True] * len(part)
                        continue
                    centres = np.array([list(c) for c in part["centres"].iloc[0]])
                    parts = _children(_matrix(part), centres, None, s.overlap)
                    pairs = dict.fromkeys((i, c) for own in parts for i, c in zip(part.index.tolist(), own.tolist(), strict=True))
                    new += [f"{shard}/{c}" for _, c in pairs]
                    source += [i for i, _ in pairs]
                    whole += [False] * len(pairs)
                at = pa.array(source, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(at) for k in range(3)), pa.array(new, pa.string()), pa.array(whole, pa.bool_())],
                    names=["node", "x", "m", "shard", "whole"])

        moved = big.join(fitted, "shard").select("node", "x", "m", "shard", "centres", "cuts").mapInArrow(
            assign, "node long, x array<double>, m long, shard string, whole boolean")
        rest = nodes.join(large, "shard", "left_anti").select("node", "x", "m", "shard", "whole")
        nodes = settled(rest.unionByName(moved))


# ---- links ------------------------------------------------------------------------------------


def adjacency(shards: DataFrame, s: Settings) -> DataFrame:
    """``node`` and ``near``: the union of its neighbour lists over its shards."""
    def build(key, frame: pd.DataFrame) -> pd.DataFrame:
        graph, ids = build_graph(_matrix(frame), s), frame["node"].to_numpy()
        node, at = np.nonzero(graph >= 0)
        to = graph[node, at]
        # A list pruned at one end still leads there from the other: own neighbours first, then those that name this node.
        lists: list[list[int]] = [[] for _ in ids]
        for a, b in [*zip(node.tolist(), to.tolist(), strict=True), *zip(to.tolist(), node.tolist(), strict=True)]:
            lists[a].append(b)
        return pd.DataFrame({"node": ids, "near": [ids[list(dict.fromkeys(v))].tolist() for v in lists]})

    lists = shards.groupBy("shard").applyInPandas(build, "node long, near array<long>")
    return lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def homes_of(shards: DataFrame) -> DataFrame:
    """All shards of each node, in order."""
    return shards.groupBy("node").agg(F.sort_array(F.collect_set("shard")).alias("homes"))


def _owner(frame: pd.DataFrame, shard: str) -> tuple[np.ndarray, np.ndarray]:
    """The kind of each row, by its shards, and whether a pair of kinds counts its links in this shard."""
    homes = [tuple(h) for h in frame["homes"]]
    same = {h: i for i, h in enumerate(dict.fromkeys(homes))}
    return np.array([same[h] for h in homes]), np.array([[min(set(g) & set(h)) == shard for h in same] for g in same])


def shard_links(shards: DataFrame, near: DataFrame, homes: DataFrame, s: Settings) -> DataFrame:
    """For every node of every shard: links whose lowest common shard this is, and a local root.

    Both ends of a pair count it in the same one of their common shards, so counts add up over
    shards without any pair leaving its task.
    """
    rows = shards.join(near, "node").join(homes, "node")

    def search(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node").reset_index(drop=True)
        x, ids = _matrix(frame), frame["node"].to_numpy()
        lists = []
        for found in frame["near"]:
            at = np.minimum(np.searchsorted(ids, found), len(ids) - 1)
            lists.append(at[ids[at] == found])  # neighbours that are in this shard too
        a, b = range_search(x, lists, s)
        kind, owner = _owner(frame, key[0])
        mine = owner[kind[a], kind[b]]
        links, copies = np.zeros(len(ids), dtype=np.int64), frame["m"].to_numpy()
        np.add.at(links, a[mine], copies[b[mine]])
        np.add.at(links, b[mine], copies[a[mine]])
        return pd.DataFrame({"node": ids, "links": links, "root": ids[local_roots(len(ids), a, b)]})

    return rows.groupBy("shard").applyInPandas(search, "node long, links long, root long")


def _reached(near: np.ndarray, same: bool) -> np.ndarray:
    """The smallest position reachable, of the rows and then of the columns (``same``: the rows again)."""
    high = near.shape[0]
    root = np.arange(high if same else sum(near.shape), dtype=np.int32)
    none = np.int32(len(root))
    while True:
        before = root.copy()
        columns = slice(0 if same else high, None)
        root[columns] = np.minimum(root[columns], np.where(near, root[:high, None], none).min(axis=0))
        root[:high] = np.minimum(root[:high], np.where(near, root[None, columns], none).min(axis=1))
        root = root[root]
        if (root == before).all():
            return root


def whole_links(shards: DataFrame, homes: DataFrame, s: Settings) -> DataFrame:
    """What :func:`shard_links` gives, from all pairs of every shard: each block against each, a task's work each.

    Links are counted in the tasks; a vector goes to as many of them as its shard has blocks.
    """
    blocks = shards.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / s.block).cast("int").alias("blocks"))
    dealt = shards.join(homes, "node").join(blocks, "shard").withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "x", "m", "homes", "block", "shard", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))

    def compare(key, frame: pd.DataFrame) -> pd.DataFrame:
        shard, low, high = key
        frame = frame.sort_values(["block", "node"]).reset_index(drop=True)
        ids, copies, same = frame["node"].to_numpy(), frame["m"].to_numpy(), low == high
        first = len(frame) if same else int((frame["block"] == low).sum())
        a, b = slice(0, first), slice(0 if same else first, None)
        links, root = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        if 0 < first and (same or first < len(ids)):
            x, (kind, owner) = _matrix(frame), _owner(frame, shard)
            near = np.empty((first, len(x[b])), dtype=bool)
            for at in range(0, first, 512):
                part = slice(at, min(first, at + 512))
                hit = x[part] @ x[b].T >= s.similarity
                if same:
                    hit[np.arange(len(hit)), np.arange(at, at + len(hit))] = False
                near[part] = hit
                mine = hit if owner.all() else hit & owner[kind[part, None], kind[None, b]]
                links[part] += mine @ copies[b]
                if not same:
                    links[b] += copies[part] @ mine
            root = _reached(near, same)
        return pd.DataFrame({"node": ids, "links": links, "root": ids[root]})

    return paired.groupBy("shard", "low", "high").applyInPandas(compare, "node long, links long, root long")


#: Vectors that a task of the audit compares its queries with.
AUDIT_PART = 16_384


def audit_recall(nodes: DataFrame, found: DataFrame, s: Settings) -> DataFrame:
    """By label (``shard``): links ``found`` of those (``true``) that a sample has with all vectors of its label.

    The sample grows with the square root of the label's vectors, so a label of at most ``s.audit``
    is compared whole.
    """
    sizes = nodes.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "parts", F.ceil(F.col("n") / AUDIT_PART).cast("int"))
    sized = nodes.join(sizes, "shard")
    rate = F.greatest(F.lit(float(s.audit)), s.audit_root * F.sqrt("n")) / F.col("n") * float(1 << 30)
    asked = sized.filter(F.pmod(F.xxhash64("node", F.lit(9)), F.lit(1 << 30)) < rate).select(
        "node", "x", "m", "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("asked"))
    every = sized.select(
        "node", "x", "m", "shard", F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts")).cast("int").alias("part"), F.lit(False).alias("asked"))

    def compare(key, frame: pd.DataFrame) -> pd.DataFrame:
        ask, rows = frame[frame["asked"]], frame[~frame["asked"]]
        ids, links = ask["node"].to_numpy(), np.zeros(len(ask), dtype=np.int64)
        if len(ask) and len(rows):
            queries, x, nodes, copies = _matrix(ask), _matrix(rows), rows["node"].to_numpy(), rows["m"].to_numpy()
            for at in range(0, len(ids), 256):
                part = slice(at, at + 256)
                links[part] = ((queries[part] @ x.T >= s.similarity) & (ids[part, None] != nodes[None, :])) @ copies
        return pd.DataFrame({"shard": key[0], "node": ids, "links": links})

    true = asked.unionByName(every).groupBy("shard", "part").applyInPandas(
        compare, "shard string, node long, links long").groupBy("shard", "node").agg(F.sum("links").alias("true"))
    return true.join(found, "node", "left").groupBy("shard").agg(
        F.sum(F.least(F.coalesce("links", F.lit(0)), "true")).alias("found"), F.sum("true").alias("true"))


def near_vectors(vectors: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id",
                 vector: str = "embedding", label: str = "label") -> DataFrame:
    """``id_col``, ``n_links``, ``component_id`` and ``kept`` for every row.

    Vectors of one label are dealt out to overlapping cluster shards; every shard gets a
    robust-pruned graph; a node's lists from all its shards are joined; range searches from each
    shard's medoids then find the pairs, verified in double precision. Families of near copies larger
    than a shard are compared whole, block by block. Recall is measured on a sample of each label
    against all its rows; where it falls short, a wider index is built, twice at most, and then all
    pairs of the label are compared.

    Rows with equal vectors and labels are one node (named by a 64-bit hash of both), whose copies link
    to one another. NULL, zero
    and non-finite vectors, and vectors without a label, link with nothing. Rows with a NULL id count
    as links of others but name no component. An empty table gives an empty result.
    """
    good = usable(F.col(vector), F.col(label))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("v"), F.col(label).cast("string").alias("shard"), good.alias("good"))
    marked = settled(rows.filter("good").select("id", F.xxhash64("shard", "v").alias("node"), "shard", F.transform("v", lambda v: v.cast("double")).alias("v")))
    peak = F.array_max(F.transform("v", F.abs))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, v: a + v * v))
    nodes = settled(
        marked.groupBy("node").agg(
            F.min("id").alias("first"), F.count(F.lit(1)).alias("m"), F.first("shard").alias("shard"), F.first("v").alias("v"))
        .withColumn("v", F.transform("v", lambda v: v / peak)).withColumn("length", length)
        .select("node", "first", "m", F.transform("v", lambda v: v / F.col("length")).alias("x"), "shard"))
    s, left, parts = settings, nodes.select("node", "x", "m", "shard"), []
    for _ in range(3):
        shards = settled(split_shards(left, s))
        homes, flat, whole = settled(homes_of(shards)), shards.filter("not whole"), shards.filter("whole")
        found = shard_links(flat, settled(adjacency(flat, s)), homes, s)
        found = settled(found if whole.isEmpty() else found.unionByName(whole_links(whole, homes, s)))
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        short = settled(audit_recall(left, links, s).filter(F.col("found") < s.recall * F.col("true")).select("shard"))
        if short.isEmpty():
            parts.append(found)
            break
        left = settled(left.join(short, "shard").select("node", "x", "m", "shard"))
        parts.append(found.join(left.select("node"), "node", "left_anti"))
        s = replace(s, overlap=s.overlap + 1, beam=2 * s.beam, degree=s.degree + 16)
    else:
        parts.append(settled(whole_links(left, homes_of(left), s)))
    found = reduce(DataFrame.unionByName, parts)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = component_roots(found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    rooted = nodes.select("node", "first", "m").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(lowest, "root").join(links, "node", "left").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"))
    linked = marked.select("id", "node").join(labels, "node").select("id", "n_links", "component_id")
    alone = rows.filter("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
