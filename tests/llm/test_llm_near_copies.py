"""The near-duplicate stage against all pairs of five-word shingle sets."""

import random

import numpy as np
from llm_cases import clashing, documents

from rainpanel.llm import near_copies


def shingles(text):
    words = (text or "").split()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited_copies():
    """Families of edited copies (1 to 4 words of 200 replaced), and texts of their own."""
    draw = random.Random(3)
    words = [f"word{n}" for n in range(4_000)]
    rows = []
    for family in range(60):
        text = draw.choices(words, k=200)
        rows.append((len(rows), " ".join(text)))
        for _ in range(family % 4):
            copy = list(text)
            for at in draw.sample(range(200), draw.randint(1, 4)):
                copy[at] = draw.choice(words)
            rows.append((len(rows), " ".join(copy)))
    # A passage shared by otherwise different texts is no near copy.
    shared = draw.choices(words, k=60)
    rows += [(len(rows) + n, " ".join(shared + draw.choices(words, k=140))) for n in range(40)]
    return rows


def reachable(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and likeness(sets[a], sets[b]) >= 0.8]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(root[a], root[b])
            changed |= root[a] != root[b]
            root[a] = root[b] = least
    return root, links


def test_edited_copies_against_all_pairs(spark):
    rows = edited_copies()
    want, links = reachable(rows)
    got = {r.doc_id: r.component_id for r in near_copies.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got.keys() == want.keys() and len(links) > 60
    assert sum(got[a] == got[b] for a, b in links) > 0.95 * len(links)
    assert all(want[i] == want[got[i]] for i in got)  # nothing joined that all pairs keep apart


def test_crowded_cells_lose_no_link(spark, monkeypatch):
    """A family of different texts that takes the spanning forest, cut cells and the second round."""
    draw = random.Random(5)
    words = [f"word{n}" for n in range(4_000)]
    base = draw.choices(words, k=200)
    rows = []
    for n in range(300):
        copy = list(base)
        copy[draw.randrange(200)] = f"own{n}"
        rows.append((n, " ".join(copy)))
    rows += [(1000 + n, " ".join(draw.choices(words, k=200))) for n in range(50)]
    monkeypatch.setattr(near_copies, "CELL_LIMIT", 40)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_copies.near_groups(frame).collect()}
    assert got == reachable(rows)[0]


def test_odd_rows(spark):
    docs = documents(spark)
    got = sorted(((r.doc_id, r.component_id) for r in near_copies.near_groups(docs).collect()), key=str)
    want = {1: 1, 2: 2, 3: 2, 4: 2, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9, 10: 1, 11: 11}
    assert [g for g in got if g[0] is not None] == sorted(((i, want[i]) for i in (*want, 10)), key=str)
    assert sorted((g[1] for g in got if g[0] is None), key=str) == [2, None]
    names = clashing(docs)
    for name in ("row", "doc", "node", "root", "first", "part", "cell", "id"):
        names = names.withColumn(name, names.text)
    kept = near_copies.keep_one_each(names)
    assert kept.columns == names.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 5, 6, 7, 8, 9, 11, None} and kept.count() == 9
    assert near_copies.keep_one_each(docs.limit(0)).count() == 0


def test_pivot_tables_lose_no_pair():
    draw = np.random.default_rng(1)
    blocks = draw.integers(0, 2, (4_000, 12), dtype=np.uint8)
    for table in (0, 5):
        cells = near_copies.pivot_cells(blocks, table)
        assert set(cells % (1 << near_copies.TABLE_BITS)) == {table}
        by_block = {}
        for block, cell in zip(map(bytes, blocks), cells, strict=True):
            assert by_block.setdefault(block, cell) == cell
        assert len(set(cells)) > 0.9 * len(by_block)
    prints = draw.integers(0, 1 << 64, (200, near_copies.WORDS), dtype=np.uint64)
    places = near_copies.coordinates(prints).astype(int)
    for a, b in draw.integers(0, 200, (500, 2)):
        assert np.abs(places[a] - places[b]).max() <= np.bitwise_count(prints[a] ^ prints[b]).sum()


def test_shared_shingles_by_table_and_by_pair(monkeypatch):
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 3_000, n)) for n in draw.integers(0, 400, 60)]
    left, right = np.triu_indices(60, 1)
    want = [len(set(sets[a].tolist()) & set(sets[b].tolist())) for a, b in zip(left, right, strict=True)]
    assert near_copies.common(sets, left, right).tolist() == want
    monkeypatch.setattr(near_copies, "DENSE_ROWS", 0)
    assert near_copies.common(sets, left, right).tolist() == want


def test_a_family_below_the_similarity_brings_no_pairs(spark, monkeypatch):
    """Texts near the similarity but below it: their pairs, which no link joins, stay in the tasks."""
    draw = random.Random(8)
    words = [f"word{n}" for n in range(4_000)]
    base = draw.choices(words, k=200)
    rows = []
    for n in range(300):
        copy = list(base)
        for at in range(draw.randrange(33), 200, 33):
            copy[at] = draw.choice(words)
        rows.append((n, " ".join(copy)))
    want, _ = reachable(rows)
    brought, verified = [], near_copies._verified

    def counted(pairs, *rest):
        brought.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(near_copies, "_verified", counted)
    got = {r.doc_id: r.component_id for r in near_copies.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(want[i] == want[got[i]] for i in got) and len(set(got.values())) <= 1.05 * len(set(want.values()))
    assert sum(brought) <= near_copies.FIRST_TABLES * len(rows)
