import pytest

from stintlab.llm.decontaminate import LeakRules, drop_leaks, find_leaks, leak_indexes, question_and_answer
from tests.llm.tables import ODD_ROWS, docs, with_extra_columns

ITEMS = [
    (1, "Which river flows through the old capital of the northern province? It is the Silverwater river, said the guide."),
    (2, "The committee met on a cold morning to settle the matter of bridges. What did they build first?\nA wooden ferry landing near mills."),
    (3, "Short one."), (4, None), (5, ""), (None, "An item that has no identifier at all, so nobody could name it."),
    (6, " ".join(f"longitem{i} word{i % 17}" for i in range(150)) + ". Final answer words here."),
]


def items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def filler(rng):
    words = [f"fill{i}" for i in range(300)] + ["the", "of", "a", "it", "is", "and"] * 20
    return lambda n: " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def indexes(spark):
    return leak_indexes(items(spark))


def test_copies_in_any_place_and_spelling(spark, indexes, filler):
    texts = {
        1: filler(300) + " " + ITEMS[0][1] + " " + filler(50), 2: ITEMS[1][1].upper().replace("\n", "   "), 3: filler(1000),
        4: filler(7) + ITEMS[6][1] + filler(40), 5: ITEMS[0][1].replace("guide", "clerk") + filler(30), 6: ITEMS[0][1].split("?")[0] + filler(60),
    }
    got = {(r["doc_id"], r["item_id"]) for r in find_leaks(docs(spark, list(texts.items())), indexes).collect()}
    assert {(1, 1), (2, 2), (4, 6), (5, 1)} <= got
    assert not any(i == 3 for i, _ in got)


def test_words_of_an_item_without_its_wording_are_no_leak(spark, indexes, rng):
    words = ITEMS[0][1].split()
    rng.shuffle(words)
    assert find_leaks(docs(spark, [(1, " ".join(words))]), indexes).count() == 0


def test_wand_equals_scoring_everything(indexes, rng):
    (one,) = indexes
    index = one.index
    words = sorted(index.postings)
    for _ in range(300):
        passage = set(rng.sample(words, rng.randint(1, min(60, len(words)))))
        near = rng.randrange(len(index.items))
        passage |= {w for w in words if near in index.postings[w][0] and rng.random() < 0.7}
        scores = {}
        for w in passage:
            for piece, impact in zip(*index.postings[w]):
                scores[piece] = scores.get(piece, 0) + impact
        want = {p: s for p, s in scores.items() if s >= index.threshold}
        assert index.search(passage) == want
        assert not want or index.may_match(passage)


def test_shards_do_not_change_the_result(spark, indexes, filler):
    table = docs(spark, [(i, filler(20) + " " + t + " " + filler(20)) for i, t in ITEMS if i and t])
    few = leak_indexes(items(spark), LeakRules(shard_postings=40))
    assert len(few) > 1
    rows = lambda x: sorted(tuple(r) for r in find_leaks(table, x).collect())
    assert rows(few) == rows(indexes)


def test_documents_that_leak_go(spark, indexes, filler):
    table = with_extra_columns(docs(spark, [(1, filler(40)), (2, ITEMS[0][1]), (3, filler(10) + ITEMS[1][1])]))
    kept = drop_leaks(table, indexes)
    assert kept.columns == table.columns and [r["doc_id"] for r in kept.collect()] == [1]


def test_question_and_answer():
    assert question_and_answer("What is it? A dog.") == (["what", "is", "it"], ["a", "dog"])
    assert question_and_answer("one two three four") == (["one", "two", "three"], ["four"])
    assert question_and_answer("...") == ([], [])


def test_awkward_rows_and_empty_tables(spark, indexes):
    table = with_extra_columns(docs(spark, ODD_ROWS))
    assert find_leaks(table, indexes).count() == 0
    assert drop_leaks(table, indexes).count() == len(ODD_ROWS)
    assert find_leaks(table.limit(0), indexes).count() == 0
    nothing = leak_indexes(items(spark, [(1, None), (2, "")]))
    assert nothing == [] and find_leaks(table, nothing).count() == 0 and drop_leaks(table, nothing).count() == len(ODD_ROWS)
