import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as s

from bagwise.llm import bpe, pack
from bagwise.llm.queries import word_bpe
from tests.llm.conftest import frame, prose

ENCODER = bpe.encoder_of(word_bpe())


def plain(text):
    return ENCODER.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(s.text(alphabet="abehinst'SLld \n.,!?9é́ÉİΣσ\x1c<|endoftext|>", max_size=400))
def test_tree_equals_the_library(text):
    ids = bpe.tree_encode_many([text], ENCODER, leaf=20, window=4)[0]
    assert ids.tolist() == plain(text)
    assert ENCODER.decode(ids) == ENCODER.tokenizer.decode(plain(text), skip_special_tokens=False)


def test_long_unsplit_text():
    r = random.Random(2)
    for alphabet in ("abehinst", "!'?.-", "0123456789", "aé́"):
        text = "".join(r.choice(alphabet) for _ in range(3000))
        assert bpe.tree_encode_many([text], ENCODER, leaf=64, window=4)[0].tolist() == plain(text)


def test_rows(spark, odd):
    want = {}
    for r in odd.select("doc_id", "text").collect():
        want[r[0], r[1] or ""] = plain(r[1] or "")
    for spread in (1 << 20, 100):  # in the task that read the text, and dealt out in parts
        got = bpe.bpe_encode_decode(odd, word_bpe(), leaf=64, window=8, spread=spread).collect()
        assert len(got) == odd.count()
        ids = sorted((g.doc_id is None, g.doc_id or 0, np.frombuffer(g.ids, "<u4").tolist()) for g in got)
        rows = sorted((r[0] is None, r[0] or 0, want[r[0], r[1] or ""]) for r in odd.select("doc_id", "text").collect())
        assert ids == rows
        assert all(g.decoded == ENCODER.tokenizer.decode(np.frombuffer(g.ids, "<u4").tolist(), skip_special_tokens=False) for g in got)
    assert bpe.bpe_encode_decode(odd.limit(0), word_bpe()).count() == 0


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 700, 2047, 2048, 2049, 5000])
def test_cuts(n):
    lengths = pack.cut_lengths(n)
    assert sum(lengths) == n and all(0 < x <= 2048 for x in lengths)


def test_packing(spark, odd, rng):
    docs = odd.unionAll(frame(spark, [prose(rng, rng.choice([5, 60, 900, 3000])) for _ in range(150)], ids=range(100, 250)))
    got = pack.harmonic_pack(docs.repartition(5), word_bpe()).collect()
    sequences, by_doc = {}, {}
    for g in got:
        assert g.length == len(g.ids) // 4
        sequences.setdefault(g.sequence_id, []).append((g.offset, g.length))
        by_doc.setdefault(g.doc_id, []).append((g.start, g.ids))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    texts = {r[0]: r[1] for r in docs.filter("doc_id >= 100").select("doc_id", "text").collect()}
    for doc, text in texts.items():
        ids = b"".join(i for _, i in sorted(by_doc[doc]))
        assert np.frombuffer(ids, "<u4").tolist() == plain(text) + [1]
    total = sum(g.length for g in got)
    assert total == sum(len(plain(r[0] or "")) + 1 for r in docs.select("text").collect())
    assert len(sequences) * 2048 < 1.1 * total + 3 * 2048  # only the last sequence of the rest is far from full
    assert pack.harmonic_pack(odd.limit(0), word_bpe()).count() == 0
