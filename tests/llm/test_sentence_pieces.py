import hashlib

import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as entry
from stintlab.llm import sentence_pieces
from stintlab.llm.sentence_pieces import PieceModel
from tests.llm.tables import ODD_ROWS, docs, with_extra_columns

DATA = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("piece_bpe_32k.model")


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def with_normalizer(rule, prefix, trim):
    """The model with another compiled character map; a later message replaces settings of an earlier one."""
    spec = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec()
    spec += bytes([3 << 3, prefix, 4 << 3, trim])
    with open(PATH, "rb") as f:
        return f.read() + bytes([3 << 3 | 2]) + varint(len(spec)) + spec


@pytest.fixture(scope="module")
def texts(rng):
    letters = [chr(i) for i in range(0x250)] + list("  \n\n\t'▁▁ΣσİıǅœﬁﬃＡ㌔中文日本語😀️ㅎㅏ각ﷺ¨…½①　 ​")
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    out += ["".join(rng.choice("ab  '\n▁.e") for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    return out + ["a" * 3000, "x ▁" * 500, "中" * 2000, " ", "  ", "", "\x08", " \x08 ", "<s> <unk> <0x0A>", "a\x00b", "▁" * 50]


def same_as_library(data, texts):
    model, library = PieceModel(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in texts:
        want = library.encode(text, return_type="proto").pieces
        ids, begins, ends = (a.tolist() for a in model.encode(text))
        assert ids == [p.id for p in want], text
        assert list(zip(begins, ends)) == [(p.begin, p.end) for p in want], text
        assert model.decode(ids) == library.decode(ids), text


def test_ids_spans_and_text_are_those_of_the_library(texts):
    with open(PATH, "rb") as f:
        same_as_library(f.read(), texts)


@pytest.mark.parametrize("rule, prefix, trim", [("nmt_nfkc", 1, 1), ("nmt_nfkc", 0, 0), ("nfkc_cf", 1, 0), ("nmt_nfkc_cf", 0, 1)])
def test_compiled_maps(texts, rule, prefix, trim):
    same_as_library(with_normalizer(rule, prefix, trim), texts)


def test_bytes_that_are_no_character():
    with open(PATH, "rb") as f:
        data = f.read()
    model, library = PieceModel(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    for ids in ([3 + 0xE6, 3 + 0x97], [3 + 0xE6, 3 + 0x97, 1526], [3 + 0xFF, 1526, 3 + 0x41], [1, 523, 2], [0, 523]):
        assert model.decode(ids) == library.decode(ids)


def test_models_it_cannot_apply():
    with open(PATH, "rb") as f:
        data = f.read()
    own = bytes([1 << 3 | 2]) + varint(3) + b"own" + bytes([3 << 3, 4])  # a user-defined symbol
    with pytest.raises(ValueError):
        PieceModel(data + bytes([1 << 3 | 2]) + varint(len(own)) + own)
    with pytest.raises(ValueError):
        PieceModel(data + bytes([2 << 3 | 2, 3]) + varint(35 << 3) + b"\x00")  # no byte fallback


def plain_row(library, doc_id, text):
    ids = library.encode(text or "")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), len((text or "").encode())


def test_awkward_rows(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    table = with_extra_columns(docs(spark, ODD_ROWS)).withColumnRenamed("size", "ids")
    encoded = sentence_pieces.encode_documents(table, PATH)
    decoded = sentence_pieces.decode_documents(encoded, PATH)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    steps = sorted(((r["doc_id"], len(r["ids"]), sha(",".join(map(str, r["ids"]))), sha(r["text"])) for r in decoded.collect()), key=repr)
    got = sorted((tuple(r) for r in sentence_pieces.piece_digest(table, PATH).collect()), key=repr)
    assert steps == sorted((r[:4] for r in got), key=repr)
    assert got == sorted((plain_row(library, i, t) for i, t, *_ in ODD_ROWS), key=repr)
    assert sentence_pieces.encode_documents(table.limit(0), PATH).count() == 0
    assert sentence_pieces.piece_digest(table.limit(0), PATH).count() == 0
    texts = {i: t for i, t, *_ in ODD_ROWS}
    for r in encoded.filter("doc_id = 6").collect():
        own = texts[6].encode()
        assert b"".join(own[a:b] for a, b in zip(r["begins"], r["ends"])) == own


def test_decoding_keeps_other_columns(spark):
    table = spark.createDataFrame([(1, [523, 28713], "x"), (2, None, None)], "a long, ids array<int>, text string")
    got = sentence_pieces.decode_documents(table, PATH, text="spoken").collect()
    assert [(r["a"], r["text"], r["spoken"]) for r in got] == [(1, "x", "<s"), (2, None, "")]


def test_query_matches_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in entry.queries()["op12_sentence_pieces"](spark, DATA).collect())
    assert got == sorted(plain_row(library, r["doc_id"], r["text"]) for r in rows)
