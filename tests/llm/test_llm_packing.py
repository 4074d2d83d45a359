import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from llm_cases import clashing, documents
from tokenizers import Tokenizer

from rainpanel.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def test_every_id_lies_in_one_piece(spark, tokenizer):
    rows = [(k, r.text, r.lang, r.source) for k, r in enumerate(documents(spark).collect())]
    got = packing.packing_query(clashing(documents(spark, rows))).collect()
    by_doc = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc, text, _, _ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in by_doc[doc]:
            part = np.array(ids[at:at + r.length], dtype="<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r.length
        assert at == len(ids)
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 1024 and sorted(ends) == list(range(len(ends)))
    assert packing.packing_query(documents(spark, [])).count() == 0


def test_repeated_rows_and_null_ids_are_packed_too(spark):
    got = Counter(str(r.doc_id) for r in packing.packing_query(documents(spark)).filter("start = 0").collect())
    assert got == Counter(str(r.doc_id) for r in documents(spark).collect())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("a \u00a0\n\u3000.")), max_size=16))
@example("foo \u00a0 \u00a0 bar")
def test_chunks_of_mixed_white_space(tokenizer, text):
    with open(public_tokenizers.path(packing.TOKENIZER), "rb") as file:
        encoder = test_chunks_of_mixed_white_space.__dict__.setdefault("encoder", None) or packing.ChunkEncoder(file.read())
    test_chunks_of_mixed_white_space.encoder = encoder
    got = np.frombuffer(next(iter(encoder.encode([text]))), "<u4").tolist()
    assert got == tokenizer.encode(text, add_special_tokens=False).ids


def test_sequences_are_padded(spark):
    rows = packing.sequences(packing.pack(documents(spark), carry_ids=True)).collect()
    assert {len(r.input_ids) for r in rows} == {1024}


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 3_000), max_size=40))
def test_a_plan_uses_each_piece_once(counts):
    plan, used = packing.make_plan(counts, 64), Counter()
    for lengths, n in zip(plan.combinations, plan.repeats, strict=True):
        assert sum(lengths) <= 64 and n > 0
        for v in lengths:
            used[v] += n
    assert used == Counter(counts)


def test_padding_is_small():
    rng = np.random.default_rng(0)
    counts = Counter(int(v) for v in np.clip(rng.lognormal(5.5, 1.0, 30_000), 1, 1023))
    plan = packing.make_plan(counts)
    full = sum(k * n for k, n in counts.items())
    assert sum(plan.repeats) * 1024 <= 1.005 * full
