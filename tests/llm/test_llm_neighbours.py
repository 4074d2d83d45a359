"""Nearest neighbours against comparing all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainpanel.llm import neighbours
from rainpanel.llm.neighbours import Settings, nearest_neighbours


def brute(rows, k, every):
    """{query: [(score, id)]} of the valid rows, ids once each."""
    good = {i: np.array(x, dtype=np.float32).astype(float) for i, x in rows
            if i is not None and x and all(v is not None and np.isfinite(v) for v in x) and any(x)}
    return {q: sorted((float(np.sqrt(((v - good[q]) ** 2).sum())), i) for i, v in good.items() if i != q)[:k]
            for q in good if q % every == 0}


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)


def found(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(got[r.query_id])
    return got


def recall(got, want):
    assert set(got) == {q for q, v in want.items() if v}
    assert all(len(got[q]) == len(want[q]) for q in got)
    return np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / len(want[q]) for q in got])


def clusters(n, dim=16, seed=5):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, dim))
    return [(i, (centres[i % 12] + 0.3 * draw.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


def test_recall_and_exact_scores(spark):
    rows = clusters(3_000)
    got = found(nearest_neighbours(frame(spark, rows), F.col("vec_id") % 20 == 0, 10, s=Settings(shard=400, sample=500)))
    want = brute(rows, 10, 20)
    assert recall(got, want) >= 0.9
    exact = {(q, i): s for q, v in brute(rows, 3_000, 20).items() for s, i in v}
    assert all(s == exact[q, i] for q, v in got.items() for s, i in v)


def test_uniform_directions(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(2_000, 64))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x / np.linalg.norm(x, axis=1)[:, None])]
    got = found(nearest_neighbours(frame(spark, rows), F.col("vec_id") % 20 == 0))
    assert recall(got, brute(rows, 10, 20)) >= 0.9


def test_a_third_are_copies_and_ties_go_to_smaller_ids(spark):
    rows = clusters(600, 8) + [(1_000 + i, [1.0] * 8) for i in range(300)] + [(2_000, [1.0] * 8)] * 50
    got = found(nearest_neighbours(frame(spark, rows), F.col("vec_id") % 100 == 0, 10, s=Settings(shard=64)))
    assert [i for _, i in got[1_100]] == list(range(1_000, 1_010)) and {s for s, _ in got[1_100]} == {0.0}
    assert [i for _, i in got[1_000]] == list(range(1_001, 1_011))
    assert len(got[2_000]) == 10


def test_rows_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (200, None), (1, [1.0, 1.0])]
    extra = frame(spark, rows).withColumns({c: F.lit(f"own {c}") for c in ("id", "x", "node", "near", "rank", "score", "q")})
    got = found(neighbours.neighbours_query(extra))
    assert {q: [i for _, i in v] for q, v in got.items()} == {0: [1, 100], 100: [1, 0]}


@pytest.mark.parametrize("rows", [[], [(0, None)], [(1, [1.0])], [(0, [1.0])]])
def test_empty(spark, rows):
    result = neighbours.neighbours_query(frame(spark, rows))
    assert result.columns == ["query_id", "rank", "vec_id", "score"] and result.count() == 0


def test_probes_come_in_order_of_success():
    family = neighbours.Family(4, Settings(tables=1, functions=3), 1.0, 27)
    x = np.random.default_rng(2).normal(size=(5, 4))
    inside = family.slots(x, 0)[1]
    keys = family.probed(x, 0)
    assert (keys[:, 0] == family.buckets(x, 0)).all() and all(len(set(k)) == 27 for k in keys.tolist())
    scores = np.sort(family.scores(inside), axis=1)
    assert np.allclose(scores[:, 1], np.minimum(inside, 1 - inside).min(axis=1) ** 2)
