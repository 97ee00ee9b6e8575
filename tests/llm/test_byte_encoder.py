"""Byte-level ids of many texts at once."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from stintlab.llm import vocab
from stintlab.llm.vocab import ByteEncoder, load_file

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'", "'S", "'r", "'l", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "a", "sé", "Ü", "e", "l", "7", "²", "!", "…", "\xad", "_", "ÿ", "Ã"]


@pytest.fixture(scope="module")
def encoder():
    return ByteEncoder(load_file(BYTES))


@pytest.fixture(scope="module")
def texts(rng):
    out = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    return out + ["x" * 3000, "<|endoftext|> a", " ", "", "'", "日本", "a'", "'re", "'r", "e's"]


def test_each_text_as_if_alone(encoder, texts):
    library = Tokenizer.from_file(BYTES)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    got = encoder.encode_all(pa.array(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    # Nulls, a slice of an array, and the other string type.
    some = pa.array([None, "left out", *texts[:50], None, *texts[-10:]], pa.large_string()).slice(2)
    got = encoder.encode_all(some)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [*want[:50], [], *want[-10:]]
    assert encoder.encode_all(pa.array([], pa.string())) == []
    assert encoder.encode_all(pa.array([None, ""], pa.string())) == [b"", b""]


def test_pre_tokens_begin_where_the_expression_says(encoder, texts):
    plain = [t for t in texts if encoder._simple(t)]
    raw = [t.encode() for t in plain]
    firsts = np.cumsum([0, *map(len, raw)])
    starts = encoder._starts(np.frombuffer(b"".join(raw), "u1"), firsts[:-1])
    lengths = [len(w.encode()) for t in plain for w in encoder.split(t)]
    assert np.diff([*starts, firsts[-1]]).tolist() == lengths


def test_new_words_are_merged_many_at_once(encoder):
    calls = []

    class Model:
        def tokenize(self, letters):
            calls.append(letters)
            return own.tokenize(letters)

        token_to_id = staticmethod(encoder.model.token_to_id)

    own, encoder.model = encoder.model, Model()
    try:
        encoder.encode(" ".join(f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100]}" for i in range(1000)))
    finally:
        encoder.model = own
    assert 1 <= len(calls) <= 10


def test_words_met_again_outlast_a_full_cache(monkeypatch):
    monkeypatch.setattr(vocab, "CACHE_WORDS", 400)
    encoder, made = ByteEncoder(load_file(BYTES)), []
    make = encoder._make_all
    monkeypatch.setattr(encoder, "_make_all", lambda words: made.extend(words) or make(words))
    letters = "abcdefghijklmnopqrst"
    for i in range(200):
        encoder.encode("again " + " ".join(f"new{letters[i % 20]}{letters[i // 20]}{letters[k]}" for k in range(20)))
    assert made.count("again") == 1
    assert len(encoder.kept) + len(encoder.often) <= 400


def test_tokenizers_with_other_rules_merge_word_by_word(encoder, texts, monkeypatch):
    other = ByteEncoder(load_file(BYTES))
    monkeypatch.setattr(other, "apart", None)
    assert other.encode_all(pa.array(texts)) == encoder.encode_all(pa.array(texts))
    assert other._inert_letter({"type": "BPE", "ignore_merges": True, "vocab": {}, "merges": []}) is None
