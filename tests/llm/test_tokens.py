"""Token counts and packing against the tokenizer library."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linkflow.llm import packing, subwords
from linkflow.llm.subwords import encoder
from linkflow.llm.token_counts import token_counts
from tests.llm.data import ROWS, docs

TOK = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids(text):
    return TOK.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(
    st.sampled_from("ab Z's \t\n.1éÉ<|́Σß×"), st.characters(codec="utf-8")), max_size=40), max_size=4))
def test_ids_equal_the_library(texts):
    flat, bounds = encoder("word_bpe_49k.json").ids(pa.array(texts, pa.string()))
    assert [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [ids(t) for t in texts]


@pytest.mark.parametrize("vocab", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_vocabularies_and_long_texts(vocab):
    path = public_tokenizers.path(vocab)
    texts = ["plain words, then more words. " * 6000, None, "", "a  b\n c", "日本" * 50]
    if vocab.endswith(".json"):
        want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    else:
        import sentencepiece
        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode([t or "" for t in texts])]
    assert encoder(vocab).counts(pa.array(texts, pa.string())).tolist() == want


def test_words_share_their_parts():
    """A pre-token is remembered once, whatever words it is part of; a full memory is cleared."""
    got = subwords.WordEncoder(subwords.vocab_file("word_bpe_49k.json"), max_words=12)
    texts = ["Stone (stone) stone, STONE's 'stone", None, "", " \u00c0 l'\u00e9t\u00e9\u00d7 x1y22 ", "\u6f22\u5b57 \u0130 \u017ft's", "new words at last"]
    for _ in range(2):
        for t in texts:
            part = pa.array([t, t], pa.string())
            want = TOK.encode(t or "", add_special_tokens=False).ids
            for found in (None, subwords.distinct_words(part)):
                ids, bounds = got.ids(part, found)
                assert ids.tolist() == want * 2 and bounds.tolist() == [0, len(want), 2 * len(want)]
            assert got.counts(part).tolist() == [len(want)] * 2
    got._clear()
    got.ids(pa.array(texts[:1]))
    assert set(got.part_at) == {"", "stone", "(", ")", ",", "'s", "tone"}


def test_token_counts(spark):
    got = sorted(map(tuple, token_counts(docs(spark)).collect()), key=str)
    want = sorted([(r[0], len((r[1] or "").encode()), n := len(ids(r[1])), n > 2048) for r in ROWS], key=str)
    assert got == want
    assert token_counts(docs(spark, [])).count() == 0


def test_pack_round_trip(spark):
    got = packing.pack(docs(spark), with_ids=True).collect()
    # pieces of a document join up to its ids
    want = Counter()
    for r in ROWS:
        whole = [*ids(r[1]), 0]
        for i, start in enumerate(range(0, len(whole), 2048)):
            part = whole[start:start + 2048]
            want[r[0], i, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
    assert Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32, tuple(p.ids)) for p in got) == want
    # sequences are full from 0 without gaps, none too long
    by = {}
    for p in sorted(got, key=lambda p: (p.sequence_id, p.offset)):
        assert by.get(p.sequence_id, 0) == p.offset
        by[p.sequence_id] = p.offset + p.length
    assert max(by.values()) <= 2048
    assert len(by) <= -(-sum(by.values()) // 2048) + 1
    assert packing.pack(docs(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=30))
def test_plan_uses_every_piece_once(histogram):
    runs = packing.plan_packing(histogram, 64)
    used = Counter()
    for lengths, n in runs:
        assert n > 0 and sum(lengths) <= 64
        for v in lengths:
            used[v] += n
    assert used == Counter(histogram)
    # never more sequences than first-fit decreasing would be allowed
    total = sum(k * n for k, n in histogram.items())
    assert sum(n for _, n in runs) <= 2 * (-(-total // 64)) + 1


def test_exact_complements_are_found():
    # pairs, triples and quadruples that fill a sequence exactly
    assert sum(n for _, n in packing.plan_packing({40: 10, 24: 10}, 64)) == 10
    assert sum(n for _, n in packing.plan_packing({30: 4, 20: 4, 14: 4}, 64)) == 4
    assert sum(n for _, n in packing.plan_packing({40: 3, 10: 3, 8: 3, 6: 3}, 64)) == 3
    assert sum(n for _, n in packing.plan_packing({32: 7}, 64)) == 4
