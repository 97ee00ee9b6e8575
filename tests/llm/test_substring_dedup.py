import pytest

from stintlab.llm.substring_dedup import SpanRules, remove_repeated, sentences_of
from tests.llm.tables import ODD_ROWS, docs, with_extra_columns


def plainly(texts, rules=SpanRules()):
    """The same by sets of word tuples, in order of id."""
    seen, out = set(), {}
    for i in sorted(texts):
        parts, words = sentences_of(texts[i], rules.longest_sentence)
        assert "".join(parts) == texts[i]
        drop = set()
        for a in range(len(parts)):
            b, n = a, 0
            while b < len(parts) and (b - a < rules.sentences or n < rules.words):
                n += len(words[b])
                b += 1
            if b - a < rules.sentences or n < rules.words:
                continue
            run = tuple(" ".join(w).lower() for w in words[a:b])
            if run in seen:
                drop |= set(range(a, b))
            seen.add(run)
        out[i] = "".join(p for j, p in enumerate(parts) if j not in drop)
    return out


@pytest.fixture
def texts(rng):
    sentence = lambda: " ".join(rng.choice("abcdefghijklmnop") * 3 for _ in range(rng.randint(1, 15))) + rng.choice([". ", ".\n", "! ", " | "])
    shared = ["".join(sentence() for _ in range(rng.randint(2, 8))) for _ in range(10)]
    parts = lambda: [sentence() if rng.random() < 0.7 else rng.choice(shared) for _ in range(rng.randint(0, 12))]
    return {i: "".join(parts()) for i in range(150)}


def test_equals_plain_form(spark, texts):
    got = {r["doc_id"]: r["text"] for r in remove_repeated(docs(spark, list(texts.items()))).collect()}
    assert got == plainly(texts)


def test_first_document_keeps_its_passage_and_clean_ones_all(spark):
    passage = " ".join(f"Sentence number {w} of the shared passage goes here." for w in "one two three four five six seven".split())
    rows = [(3, "Alone before. " + passage), (1, "Own start here. " + passage + " Own end."), (2, "Nothing shared in this text at all. Truly nothing. It is all its own, every word.")]
    got = {r["doc_id"]: r for r in remove_repeated(docs(spark, rows)).collect()}
    assert got[1]["text"] == rows[1][1] and got[2]["text"] == rows[2][1]
    assert got[3]["text"] == "Alone before. " and got[3]["first_doc"] == 1


def test_repeats_inside_one_text(spark):
    part = "One of the sentences here. Two of the sentences here. Three of the sentences here. "
    (r,) = remove_repeated(docs(spark, [(1, part * 3)])).collect()
    assert r["text"] == part


def test_awkward_rows_and_empty_table(spark):
    table = with_extra_columns(docs(spark, ODD_ROWS))
    got = remove_repeated(table).collect()
    assert len(got) == len(ODD_ROWS)
    assert {r["text"] for r in got if r["doc_id"] in (1, 2)} == {None, ""}
    # Rows with one id are one document: it does not repeat itself.
    assert [r["text"] for r in got if r["doc_id"] == 4] == [ODD_ROWS[4][1]] * 2
    assert remove_repeated(table.limit(0)).count() == 0


def test_rows_that_share_an_id_but_not_a_text(spark):
    """Null ids in particular: spans of one row are not cut from another, and repeats among them go."""
    passage = " ".join(f"Sentence number {w} of the shared passage goes here." for w in "one two three four five".split())
    own = lambda n: " ".join(f"Text {n} says thing {w} all by itself and unlike others." for w in "red green blue white black".split())
    rows = [(None, passage + " First tail."), (None, "Some other head. " + passage), (None, own(1)), (7, own(2)), (7, own(3) + " " + own(2)), (8, own(1))]
    got = sorted((r["doc_id"] or 0, r["text"]) for r in remove_repeated(docs(spark, rows)).collect())
    heads = {t.replace(passage, "").strip() for i, t in got if i == 0}
    # Id 8 comes before null ids, id 7 is one id with two texts: the one with the smaller row keeps.
    texts = [t for _, t in got]
    assert (8, own(1)) in got and (0, "") in got and len(got) == len(rows)
    assert sum(passage in t for t in texts) == 1 and heads == {"First tail.", "Some other head.", ""}
    assert sum(own(2) in t for t in texts) == 1 and sum(own(3) in t for t in texts) == 1


def test_long_passage_is_found_at_every_offset(spark, rng):
    """60 words without any full stop: of the second copy only its edges stay, whatever stands before."""
    word = lambda: f"w{rng.randrange(5000)}"
    for mark in ("", "、"):
        rows, shared = [], {}
        for offset in range(25):
            passage = [word() + mark for _ in range(60)]
            shared[offset] = passage
            rows += [(2 * offset, " ".join(passage + [word() for _ in range(20)])), (2 * offset + 1, " ".join([word() for _ in range(offset)] + passage + [word() for _ in range(20)]))]
        got = {r["doc_id"]: r["text"] for r in remove_repeated(docs(spark, rows)).collect()}
        for offset, passage in shared.items():
            before, after = rows[2 * offset + 1][1].split(), got[2 * offset + 1].split()
            assert got[2 * offset] == rows[2 * offset][1]
            # Nothing but the passage goes, and at least the 12 words of a run do.
            gone = len(before) - len(after)
            assert gone >= 12 and before[:offset] == after[:offset] and before[-20:] == after[-20:] and gone <= 60


def test_other_full_stops_and_scripts_without_blanks(spark):
    assert sentences_of("今日は天気。明日も晴れ？そう。", 12)[0] == ["今日は天気。", "明日も晴れ？", "そう。"]
    assert sentences_of("यह है। वह था। ", 12)[0] == ["यह है। ", "वह था। "]
    passage = "".join(chr(0x4E00 + i * i * 37 % 5000) for i in range(60))
    rows = [(1, passage)] + [(1 + k, "".join(chr(0x6F00 + k * 40 + i) for i in range(k)) + passage) for k in range(1, 12)]
    got = {r["doc_id"]: r["text"] for r in remove_repeated(docs(spark, rows)).collect()}
    assert got[1] == passage and all(len(got[1 + k]) <= k + 60 - 12 for k in range(1, 12))
