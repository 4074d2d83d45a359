from collections import defaultdict

import numpy as np
import pytest

from rainpanel.llm import vectors
from rainpanel.llm.vectors import Settings


def planted(n=700, seed=0):
    """Random vectors, small families of near copies, and one large one."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 16))
    for k in range(0, 200, 4):
        x[k + 1:k + 3] = x[k] + rng.normal(size=(2, 16)) * 0.1
    x[300:420] = x[299] + rng.normal(size=(120, 16)) * 0.15
    return x, rng.integers(0, 2, n)


def brute(rows, least=0.98):
    ids = [r[0] for r in rows]
    root, links = {i: i for i in ids}, dict.fromkeys(ids, 0)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    by_label = defaultdict(list)
    for i, v, lab in rows:
        v = np.array([np.nan if c is None else c for c in v], dtype=np.float32).astype(float) if v is not None else None
        if lab is not None and v is not None and len(v) and np.isfinite(v).all() and v.any():
            by_label[lab].append((i, v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max())))
    for group in by_label.values():
        x = np.array([v for _, v in group])
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= least, 1)), strict=True):
            i, j = group[a][0], group[b][0]
            links[i] += 1
            links[j] += 1
            p, q = find(i), find(j)
            root[max(p, q)] = min(p, q)
    return {i: (links[i], find(i)) for i in ids}


@pytest.mark.parametrize("settings", [Settings(), Settings(shard=100, most=160, children=8)])
def test_links_against_all_pairs(spark, settings):
    x, labels = planted()
    rows = [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, labels, strict=True))]
    rows[500:505] = [(500, None, 1), (501, [0.0] * 16, 1), (502, [float("nan")] + [1.0] * 15, 1), (503, [None] + [1.0] * 15, 1), (504, x[299].tolist(), None)]
    rows += [(900 + k, x[10].tolist(), int(labels[10])) for k in range(3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = {r.vec_id: r for r in vectors.near_vectors(frame, settings).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    assert all(got[i].n_links <= want[i][0] for i in got)
    found, there = sum(r.n_links for r in got.values()), sum(w[0] for w in want.values())
    assert found >= 0.95 * there > 0
    assert sum(got[i].component_id == want[i][1] for i in got) >= 0.99 * len(got)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_empty_and_only_bad_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vectors.near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = vectors.near_vectors(spark.createDataFrame([(1, None, None), (1, None, None), (None, [], 3)], schema)).collect()
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, [(1, 0, 1, True), (1, 0, 1, True), (None, 0, None, True)]))


def test_near_copies_are_cut_along_their_main_direction():
    rng = np.random.default_rng(1)
    x = np.ones((4_000, 8)) + rng.normal(size=(4_000, 8)) * 1e-5
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres, cuts = vectors._fit_split(x, 4_000, Settings(shard=1_000, most=1_500))
    parts = vectors._children(x, centres, cuts, 2)
    assert max(np.bincount(np.concatenate(parts))) < 0.76 * len(x)


def family(n=2_500, seed=3):
    """Near copies, all within the similarity, beside some other vectors of their label."""
    rng = np.random.default_rng(seed)
    x = np.ones((n, 16)) + rng.normal(size=(n, 16)) * 0.03
    return np.vstack([x, rng.normal(size=(100, 16))])


def test_a_family_larger_than_a_shard_is_compared_whole(spark):
    rows = [(i, v.tolist(), 1) for i, v in enumerate(family())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = vectors.near_vectors(frame, Settings(shard=200, most=400, children=8, block=300)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)


@pytest.mark.parametrize("block", [100, 4_096])
def test_a_label_that_stays_short_is_compared_whole(spark, monkeypatch, block):
    x, labels = planted()
    rows = [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, labels, strict=True))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    nothing = "node long, links long, root long"
    monkeypatch.setattr(vectors, "shard_links", lambda shards, *_: shards.sparkSession.createDataFrame([], nothing))
    got = vectors.near_vectors(frame, Settings(block=block)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)


def test_the_audit_looks_at_every_label_and_grows(spark):
    """One label of two has no links found; few of its vectors have any."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6_000, 16))
    x[1::100] = x[::100]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist(), 1, str(i // 3_000)) for i, v in enumerate(x)]
    nodes = spark.createDataFrame(rows, "node long, x array<double>, m long, shard string")
    found = spark.createDataFrame([(i, 1) for i in range(3_000)], "node long, links long")
    by_label = {r.shard: r for r in vectors.audit_recall(nodes, found, Settings(audit=200, audit_root=20.0)).collect()}
    assert by_label["0"].found == by_label["0"].true > 0
    assert by_label["1"].found == 0 < by_label["1"].true
