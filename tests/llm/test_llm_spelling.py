"""Spelling variants against edit distances of all pairs."""

import random
import re
import zlib

import pytest
from llm_cases import clashing, documents

from rainpanel.llm import spelling

LOWER = {c: c + 32 for c in range(65, 91)}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_counts(rows):
    counts = {}
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if n >= 2}


def brute(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        if found:
            best = min(found, key=lambda v: (-counts[v], v))
            if counts[best] >= 10 * counts[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()), key=repr)


def random_counts(n, letters, seed=3):
    draw = random.Random(seed)
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(7, 9))): draw.choice((2, 3, 30, 400, 5_000)) for _ in range(n)}
    for w in list(words)[::3]:  # and some one edit away
        k = draw.randrange(len(w))
        for v in (w[:k] + draw.choice(letters) + w[k + 1:], w[:k] + draw.choice(letters) + w[k:], w[:k] + w[k + 1:]):
            if len(v) >= 7:
                words.setdefault(v, draw.choice((2, 25, 300)))
    return words


@pytest.mark.parametrize("letters,tile", [("ab", 2_048), ("ab", 16), ("abcdeéÿ", 2_048), ("aß漢😀", 8)])
def test_forms_equal_brute_force(spark, rows, letters, tile):
    counts = random_counts(250, letters)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert rows(spelling.spelling_variants(frame, tile=tile)) == brute(counts)


def test_long_words_and_chains(spark, rows):
    long_ = "z" * 700
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2_000, "abcdefghijk": 20_000, long_: 2, long_[1:] + "y": 50}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = rows(spelling.spelling_variants(frame))
    assert got == brute(counts)
    assert {r[0]: r[2] for r in got}["abcdefg"] == "abcdefghijk"


def test_query_equals_brute_force(spark, rows):
    draw = random.Random(8)
    pool = list(random_counts(60, "abcÀé")) + ["SHOUTED", "Été", "straßenbahn", "anticonstitution", "×÷×÷×÷×"]
    texts = [(i, " ".join(draw.choice(pool) + draw.choice(["", ",", "1", "-", "\n", "漢", "😀".encode("utf-16", "surrogatepass").decode("utf-16")])
                          for _ in range(draw.randint(0, 200)))) for i in range(120)]
    texts += [(None, "anticonstitution anticonstitution"), (5, None), (6, ""), texts[0], texts[0]]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert rows(spelling.variants_query(frame)) == brute(brute_counts(texts))


def test_odd_rows(spark, rows):
    assert rows(spelling.variants_query(clashing(documents(spark)))) == rows(spelling.variants_query(documents(spark)))
    assert spelling.variants_query(documents(spark, [])).collect() == []
    assert spelling.variants_query(documents(spark, [(1, None, None, None)])).collect() == []


def test_few_words_are_held(spark, rows, monkeypatch):
    counts = random_counts(100, "ab")
    text = " ".join(w for w in counts for _ in range(2))
    whole = rows(spelling.word_counts(spark.createDataFrame([(1, text)], "doc_id long, text string")))
    assert sum(n for _, n in whole) > 0 and len({w for w, _ in whole}) == len(whole)
