import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stintlab.llm import token_output
from stintlab.llm.token_counts import token_counts
from stintlab.llm.vocab import ByteEncoder, WordCounter, load_file, whole_token_words
from tests.llm.tables import ODD_ROWS, docs, with_extra_columns

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def odd_texts(rng):
    letters = [chr(i) for i in range(0x250)] + list("  \n\n\t'sSTREVMLdΣσİıǅœ中文日😀")
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    out += ["".join(rng.choice("ab '\n\r\t.1sretvmld!\x85\xa0\xad\xb2é") for _ in range(rng.randint(0, 40))) for _ in range(2500)]
    out += ["a<|endoftext|>b", "<|startoftext|> it's", "", "x" * 5000, "\x1c\x1d a\x1eb"]
    return out + [f"{chr(i)}a {chr(i)}{chr(i)} b{chr(i)}" for i in range(256)]


def test_ids_are_those_of_the_library(odd_texts):
    encoder, library = ByteEncoder(load_file(BYTES)), Tokenizer.from_file(BYTES)
    for text in odd_texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_counts_are_those_of_the_library(odd_texts):
    source = load_file(WORDS)
    counter, library = WordCounter(source, whole_token_words(source)), Tokenizer.from_file(WORDS)
    for text in odd_texts:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_whole_token_words_are_one_token(rng):
    library, words = Tokenizer.from_file(WORDS), whole_token_words(load_file(WORDS))
    assert len(words) > 10_000
    for w in rng.sample(sorted(words), 500):
        assert len(library.encode(f"x {w} x", add_special_tokens=False).ids) == 3


def test_cache_that_runs_full(monkeypatch, odd_texts):
    from stintlab.llm import vocab

    monkeypatch.setattr(vocab, "CACHE_WORDS", 5)
    encoder = ByteEncoder(load_file(BYTES))
    library = Tokenizer.from_file(BYTES)
    for text in odd_texts[:200]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_token_counts_of_awkward_rows(spark):
    library = Tokenizer.from_file(WORDS)
    table = with_extra_columns(docs(spark, ODD_ROWS))
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts(table, WORDS).collect())
    want = []
    for i, t, *_ in ODD_ROWS:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i or 0, len((t or "").encode()), n, n > 2048))
    assert got == sorted(want)
    assert token_counts(table.limit(0), WORDS).count() == 0


def test_round_trip_in_order(spark, tmp_path, rng):
    library = Tokenizer.from_file(BYTES)
    rows = [(i, " ".join(rng.choice(["token", "ids", "é", "<|endoftext|>", "\n"]) for _ in range(rng.randint(0, 40)))) for i in range(-20, 400)]
    rng.shuffle(rows)
    path, rules = str(tmp_path / "tokens"), token_output.OutputRules(block_docs=7)
    token_output.write_tokens(docs(spark, rows), path, BYTES, rules)
    got = sorted(token_output.read_tokens(spark, path).collect(), key=lambda r: r["doc_id"])
    start = 0
    for r, (i, text) in zip(got, sorted(rows), strict=True):
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (i, start, len(ids))
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids
        start += len(ids)
    blocks = spark.read.parquet(f"{path}/blocks").orderBy("shard", "block").collect()
    order = [i for b in blocks for i in b["doc_ids"]]
    assert order == sorted(order)
    assert {b["dict_sha256"] for b in blocks} == {spark.read.parquet(f"{path}/dictionary").first()["dict_sha256"]}
    (one,) = token_output.read_document(spark, path, 17)
    assert one.tolist() == library.encode(dict(rows)[17], add_special_tokens=False).ids + [2]


def test_shared_dictionary_shrinks_short_texts(spark, tmp_path):
    rows = [(i, f"The quick brown fox number {i} jumps over the lazy dog and goes home again.") for i in range(500)]
    for n, size in (("with", 16 << 10), ("without", 0)):
        rules = token_output.OutputRules(dictionary_bytes=size or 256)
        if not size:
            rules = token_output.OutputRules(dictionary_bytes=256, sample_docs=0)
        token_output.write_tokens(docs(spark, rows), str(tmp_path / n), BYTES, rules)
    with_it, without = (spark.read.parquet(str(tmp_path / n / "blocks")).selectExpr("sum(length(frames))").first()[0] for n in ("with", "without"))
    assert with_it < 0.7 * without


def test_digest_of_awkward_rows(spark):
    library = Tokenizer.from_file(BYTES)
    table = with_extra_columns(docs(spark, ODD_ROWS))
    got = token_output.token_digest(table, BYTES).collect()
    assert sorted((r["doc_id"] or 0, r["ids_crc32"]) for r in got) == sorted(
        (i or 0, zlib.crc32(np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes())) for i, t, *_ in ODD_ROWS
    )
    starts = sorted((r["start"], r["n_tokens"]) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    assert token_output.token_digest(table.limit(0), BYTES).count() == 0
