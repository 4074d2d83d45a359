"""Importance resampling against a count of every feature."""

import hashlib
import math
import re
import zlib

from llm_cases import ROWS, clashing, documents

from rainpanel.llm import resampling

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [zlib.crc32(f.encode()) % 10_000 for f in [*words, *map(" ".join, zip(words, words[1:], strict=False))]]


def brute(rows, target):
    s, t = [0] * 10_000, [0] * 10_000
    for counts, texts in ((s, [r[1] for r in rows]), (t, target)):
        for text in texts:
            for b in features(text)[1]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000)))) for b in range(10_000)]
    result = []
    for doc, text in rows:
        words, found = features(text)
        weight = math.floor(sum(gain[b] for b in found) / len(found)) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        result.append([doc, len(found), weight, score, None, len(words)])
    able = sorted((r for r in result if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1:3]))
    for rank, row in enumerate(able[:25 * len(able) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, result), key=repr)


TARGET = ["the quick fox and the lazy dog", None, "", "jumps over"]


def target(spark):
    return spark.createDataFrame([(t,) for t in TARGET], "text string")


def cases():
    prose = [(100 + i, " ".join(f"{w}{i % 7}" for w in "the Quick fox\0jumps,over a lazy dog, été 漢字".split() * (1 + i % 4)), "en", "a")
             for i in range(60)]
    return [*ROWS, *prose, *prose[:5]]


def test_equals_brute_force(spark, rows):
    got = rows(resampling.resampling_query(documents(spark, cases()), target(spark)))
    assert got == brute([r[:2] for r in cases()], TARGET) and sum(r[4] is not None for r in got) > 5


def test_parts_of_a_batch_do_not_matter(spark, rows, monkeypatch):
    texts = [t.encode() if t else b"" for _, t, *_ in cases()]
    whole = resampling.batch_features(texts)
    apart = [resampling.batch_features([t]) for t in texts]
    assert sorted(zip(whole[1].tolist(), whole[0].tolist(), strict=True)) == sorted(
        (i, b) for i, one in enumerate(apart) for b in one[0].tolist())
    assert whole[2].tolist() == [int(one[2][0]) for one in apart]


def test_rows_of_their_own(spark):
    docs = clashing(documents(spark, cases()))
    drawn = resampling.resample(docs, target(spark))
    assert drawn.columns == docs.columns
    ranked = resampling.resampling_query(docs, target(spark)).filter("rank is not null")
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(r.doc_id for r in ranked.collect())


def test_empty(spark):
    none = documents(spark, [])
    assert resampling.resampling_query(none, target(spark)).collect() == []
    only = resampling.resampling_query(documents(spark, [(1, None, None, None)]), target(spark).limit(0)).collect()
    assert [tuple(r)[:3] + (r["rank"],) for r in only] == [(1, 0, 0, None)]


def test_a_draw_prefers_the_target(spark):
    like = [(i, " ".join(TARGET[0].split() * 4), "en", "a") for i in range(50)]
    other = [(1_000 + i, " ".join(f"w{i}x{j}" for j in range(30)), "en", "a") for i in range(150)]
    many = spark.createDataFrame([(t,) for t in TARGET * 1_000], "text string")
    drawn = resampling.resampling_query(documents(spark, like + other), many).filter("rank is not null").collect()
    assert len(drawn) == 50 and sum(r.doc_id < 1_000 for r in drawn) >= 30  # an even draw has 12
