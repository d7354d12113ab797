from __future__ import annotations

import hashlib

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import sentencepiece_bpe
from tickloom.llm.queries import PIECES

MODEL = public_tokenizers.path(PIECES)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
CODEC = sentencepiece_bpe.codec(MODEL)
LETTERS = st.text(alphabet=st.sampled_from(list("abtheinrs  \n\t▁é́中🎉\x00ﬁ<>0")), max_size=60)


@settings(max_examples=400, deadline=None)
@given(st.one_of(LETTERS, st.text(max_size=40)))
def test_codec_agrees_with_the_library(text):
    want = LIBRARY.encode(text, add_eos=True)
    assert CODEC.encode(text) == want
    assert CODEC.encode_array(text).tolist() == want
    assert CODEC.decode(want) == LIBRARY.decode(want)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 258)), max_size=12))
def test_any_ids_decode_as_the_library_does(ids):
    assert CODEC.decode(ids) == LIBRARY.decode(ids)


def test_long_runs_of_one_character():
    for text in ("a" * 500, " " * 77, "x" + " " * 40 + "y", "ab" * 300, "ñ" * 99):
        assert CODEC.encode(text) == LIBRARY.encode(text, add_eos=True)


def test_table_of_digests_and_round_trip(docs, corpus):
    got = sorted((tuple(r) for r in sentencepiece_bpe.digests(docs, MODEL).collect()), key=str)
    want = []
    for i, text, _, _ in corpus:
        ids = LIBRARY.encode(text or "", add_eos=True)
        told = " ".join(map(str, ids)).encode()
        want.append((i, len(ids), hashlib.sha256(told).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    back = sentencepiece_bpe.decode(sentencepiece_bpe.encode(docs, MODEL), MODEL).collect()
    assert sorted((str(r.id), r.text) for r in back) == sorted((str(i), t or "") for i, t, _, _ in corpus)


def test_empty_table(empty):
    assert sentencepiece_bpe.digests(empty, MODEL).count() == 0
