"""BPE, SimHash, quality and URL verdicts against plain Python."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import tiktoken
import xxhash
from hypothesis import example, given, settings
from hypothesis import strategies as st
from llm_cases import CLASHING, clashing, documents
from public_tokenizers import PATTERN
from pyspark.sql import functions as F

from rainpanel.llm import bpe, quality, simhash, url_filter


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(bpe.read_file())


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_comes_back(spark, reference):
    texts = Counter((r.doc_id, r.text or "") for r in documents(spark).collect())
    want = Counter()
    for (doc, text), n in texts.items():
        ids = reference.encode_ordinary(text)
        want[doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += n
    assert Counter(tuple(r) for r in bpe.bpe_query(clashing(documents(spark))).collect()) == want
    assert bpe.bpe_query(documents(spark, [])).count() == 0
    assert [c for c in bpe.encode(clashing(documents(spark))).columns if c != "ids"] == [
        "doc_id", "text", "lang", "source", *(c for c in CLASHING if c != "ids")]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aeBé1²._'s \n\t\x1c　한😀")) | st.characters(codec="utf-8"), max_size=40))
def test_bpe_on_any_text(ranks, reference, text):
    encoder = test_bpe_on_any_text.__dict__.setdefault("encoder", bpe.WordEncoder(bpe.read_file(), remembered=50))
    got = encoder.encode(text)
    assert [int.from_bytes(got[i:i + 4], "little") for i in range(0, len(got), 4)] == reference.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("a \u00a0\n\u3000.")), max_size=16))
@example("foo \u00a0 \u00a0 bar")
@example("foo \u00a0 \u00a0 \u00a0 \u00a0 ")
def test_bpe_on_runs_of_mixed_white_space(ranks, reference, text):
    encoder = test_bpe_on_runs_of_mixed_white_space.__dict__.setdefault("encoder", bpe.WordEncoder(bpe.read_file()))
    assert np.frombuffer(encoder.encode(text), "<i4").tolist() == reference.encode_ordinary(text)


def test_long_pieces_merge_alike(ranks):
    rng = random.Random(3)
    for _ in range(20):
        piece = "".join(rng.choice("abcdefghi the") for _ in range(120)).encode()
        assert bpe._fold_long(piece, ranks) == bpe.fold_merges(piece, ranks)


def test_native_fold(spark, ranks):
    rng = random.Random(4)
    words = ["", "x", " the", "aaaaaaa", "été", *("".join(rng.choice("abcdest ") for _ in range(rng.randint(1, 14))) for _ in range(40))]
    frame = spark.createDataFrame([(w.encode(),) for w in words], "w binary")
    for r in frame.select("w", bpe.native_ids(F.col("w"), bpe.read_file()).alias("i")).collect():
        assert r.i == (bpe.fold_merges(bytes(r.w), ranks) if r.w else [])


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(prints):
    """doc -> smallest doc reachable, over all pairs within two bits."""
    ids, root = list(prints), {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in ids:
        for b in ids:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_equals_all_pairs(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for k in range(60):
        base = [rng.choice(vocabulary) for _ in range(120)]
        rows.append((3 * k, " ".join(base)))
        rows.append((3 * k + 1, " ".join(base) + (" tail" if k % 2 else "")))
        base[rng.randrange(120)] = "Other"
        rows.append((3 * k + 2, " ".join(base)))
    rows += [(1000, None), (1001, ""), (1002, " \t"), (1003, "one two"), (1004, "ONE  two")]
    got = simhash.simhash_groups(clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))).collect()
    prints = {d: plain_fingerprint(t) for d, t in rows}
    assert {r.doc_id: r.fingerprint for r in got} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {r.doc_id: r.component_id for r in got} == components(prints)


def test_simhash_chains_and_crowded_cells(spark, monkeypatch):
    """Links through neighbours must equal links by pairs, also along a chain of two-bit steps."""
    rng = random.Random(2)
    prints = set()
    for _ in range(20):
        fp = rng.getrandbits(64)
        for _ in range(12):
            prints.add(fp)
            fp ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    frame = spark.createDataFrame([(v,) for v in signed.values()], "fp long")
    want = components({v: p for p, v in signed.items()})
    for limit in (2_000, 1):
        monkeypatch.setattr(simhash, "CELL_LIMIT", limit)
        roots = {r.node: r.root for r in simhash.component_roots(simhash.near_pairs(frame)).collect()}
        assert {v: roots.get(v, v) for v in signed.values()} == want


def plain_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_quality_counts(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in documents(spark).collect()]
    rng = random.Random(5)
    rows += [(100 + k, " ".join(rng.choice("the of a # * b c d e".split()) for _ in range(80)), "en", "a") for k in range(20)]
    got = quality.quality_query(clashing(documents(spark, rows))).collect()
    want = Counter((d, *plain_quality(t)) for d, t, _, _ in rows)
    assert Counter(tuple(r)[:-1] for r in got) == want
    assert all(not r.kept for r in got if r.base_failed)
    assert quality.quality_query(documents(spark, [])).count() == 0


def test_thresholds_are_a_table(spark):
    frame = documents(spark, [(1, " ".join(f"the word{i}" for i in range(60)), "en", "a"), (2, " ".join(f"#% {i}" for i in range(60)), "en", "a")])
    assert [r.doc_id for r in quality.keep_good(frame).collect()] == [1]
    loose = (quality.Threshold("symbol_ratio", None, 5.0),)
    assert quality.keep_good(frame, thresholds=loose).count() == 2
    plan = quality.keep_good(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


URLS = [
    (1, "https://a.b.com/x", "a.b.com", "/x", "com/", "allow"),
    (2, "http://www.example.com/en/1?q", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    (3, "http://x.EXAMPLE.com/en/", "x.example.com", "/en/", "example.com/en/", "block"),
    (4, "http://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
    (5, "http://casino.net/", "casino.net", "/", None, "block"),
    (6, "http://casinos.org/", "casinos.org", "/", None, "allow"),
    (7, "http://cheap.org/a-pills", "cheap.org", "/a-pills", None, "block"),
    (8, "http://cheap.org/cheap", "cheap.org", "/cheap", None, "allow"),
    (9, None, "", "", None, "allow"),
    (10, "no scheme", "", "", None, "allow"),
    (11, "http://b.com", "b.com", "", None, "allow"),
    (12, "http://notcom/\nx?y", "notcom", "/\nx", None, "allow"),
    (12, "http://notcom/\nx?y", "notcom", "/\nx", None, "allow"),
    (13, "", "", "", None, "allow"),
    (14, "http://x.org/" + "a/" * 5000 + "XXX", "x.org", "/" + "a/" * 5000 + "XXX", None, "block"),
]


def test_urls(spark):
    frame = spark.createDataFrame([u[:2] for u in URLS], "page_id long, url string").withColumn("verdict", F.lit("own"))
    assert sorted(map(str, (tuple(r) for r in url_filter.urls_query(frame).collect()))) == sorted(
        str((u[0], *u[2:])) for u in URLS)
    assert url_filter.urls_query(frame.limit(0)).count() == 0
    assert url_filter.judge_urls(frame).columns == ["page_id", "url", "host", "path", "rule", "verdict"]
