import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from stintlab.llm import langid
from tests.llm.tables import ODD_ROWS, docs, with_extra_columns

DATA = "/root/testdata/sf0.01"
TAUGHT = {
    "en": "the quick brown fox thinks that nothing is better than this other thing with which they were there",
    "de": "der schnelle braune fuchs denkt dass nichts besser ist als dieses andere ding mit dem sie dort waren",
    "ru": "быстрая коричневая лиса думает что нет ничего лучше чем эта другая вещь с которой они были там",
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, text, lang) for i, (lang, text) in enumerate(TAUGHT.items())]
    return langid.train_languages(docs(spark, rows), F.lit(True))


def test_spans_of_mixed_text(model):
    text = f"{TAUGHT['en']} {TAUGHT['ru']} {TAUGHT['de']}"
    n = [len(t.split()) for t in TAUGHT.values()]
    spans = langid.language_spans(text, model)
    assert [s[0] for s in spans] == ["en", "ru", "de"]
    # The script fixes one border exactly.
    assert spans[1][1:] == (n[0], n[0] + n[2])


def test_script_narrows_candidates(model):
    scores, _ = langid._word_scores(["лиса", "fox", "日本"], model)
    en, de, ru = (model.languages.index(x) for x in ("en", "de", "ru"))
    assert np.isinf(scores[0, [en, de]]).all() and np.isinf(scores[1, ru]) and np.isfinite(scores[1, [en, de]]).all()
    assert (scores[2] == 0).all()


def test_viterbi_is_the_best_of_all_paths(rng):
    draw = np.random.default_rng(5)
    for penalty in (0.0, 0.7, 3.0):
        lengths = [5, 1, 0, 7, 3]
        scores = draw.normal(size=(sum(lengths), 3)).astype(np.float32)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        labels = langid._viterbi(scores, np.arange(len(scores)), starts, penalty)
        value = lambda path, at: sum(scores[at + i, p] for i, p in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))
        for a, n in zip(starts, lengths):
            best = max((value(p, a) for p in itertools.product(range(3), repeat=n)), default=0)
            assert value(labels[a : a + n], a) == pytest.approx(best, abs=1e-4)


def test_held_out_accuracy(spark):
    import __spark_entry__ as entry

    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = entry.queries()["op10_language_id"](spark, DATA).collect()
    assert len(rows) == len(truth) and all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"]]) > 0.97


def test_rejected_and_kept(spark, model):
    rows = [(1, TAUGHT["en"]), (2, "12 34 !!"), (3, None), (4, TAUGHT["de"])]
    table = with_extra_columns(docs(spark, rows))
    kept = langid.keep_identified(table, model)
    assert kept.columns == table.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 4]


def test_awkward_rows_and_empty_tables(spark, model):
    table = with_extra_columns(docs(spark, ODD_ROWS))
    got = langid.predict_languages(table, model).collect()
    assert len(got) == len(ODD_ROWS)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert langid.predict_languages(table.limit(0), model).count() == 0
    untaught = langid.train_languages(docs(spark, [(1, None, "en"), (2, "x", None)]), F.lit(True))
    assert {r["lang_pred"] for r in langid.predict_languages(table, untaught).collect()} == {"und"}
    assert langid.keep_identified(table, untaught).count() == len(ODD_ROWS)


def test_long_runs_are_read_whole(model):
    """Without blanks: every letter counts, once, and languages and scripts inside a run are found."""
    en, de, ru = (TAUGHT[x].replace(" ", "") for x in ("en", "de", "ru"))
    long = en[:16] + de * 10 + en[-16:]
    spans = langid.language_spans(long, model)
    assert "de" in {s[0] for s in spans}
    mass, _ = langid._letters_by_language([long, en + ru], model)
    assert mass[0].sum() == len(long) and mass[0].argmax() == model.languages.index("de")
    assert mass[1, model.languages.index("ru")] == len(ru)
    # The n-grams of the pieces are those of the uncut word.
    rules = model.rules
    grams = lambda words: sorted(x for b, real in langid._grams(*langid._codes(words, rules), rules) for x in b[real].tolist())
    assert grams(list(langid._pieces(long + ru))) == grams([long + ru])


def test_unlearned_scripts_and_mixed_texts_are_rejected(spark, model):
    han = "".join(chr(0x4E00 + i) for i in range(70))
    # About a third of the letters each.
    mixed = " ".join(" ".join([t] * 3) for t in TAUGHT.values())
    rows = [(1, han), (2, "fox " + han), (3, TAUGHT["en"] + " " + han[:5]), (4, mixed), (5, TAUGHT["ru"])]
    table = docs(spark, rows)
    assert sorted(r["doc_id"] for r in langid.keep_identified(table, model).collect()) == [3, 5]
    got = {r["doc_id"]: r for r in langid.predict_languages(table, model).collect()}
    assert (got[1]["lang_pred"], got[1]["score"]) == (model.languages[0], 0) and got[2]["score"] < 0.1 and got[3]["lang_pred"] == "en"


def test_foreign_scripts_against_a_latin_model(spark):
    """`und` is for texts without letters alone; the filter goes on rejecting scripts that were not learned."""
    latin = langid.train_languages(docs(spark, [(i, TAUGHT[x], x) for i, x in enumerate(("en", "de"))]), F.lit(True))
    rows = [(1, "中文文本没有空格"), (2, TAUGHT["ru"]), (3, "1234 -- 5"), (4, TAUGHT["de"]), (5, "中 fox"), (None, "日本語")]
    table = docs(spark, rows)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict_languages(table, latin).collect()}
    assert got[1] == got[2] == got[None] == ("de", 0) and got[3] == ("und", 0)
    assert got[4][0] == "de" and got[5][0] in ("de", "en") and got[5][1] > 0
    assert [r["doc_id"] for r in langid.keep_identified(table, latin).collect()] == [4, 5]


def test_null_ids_are_in_no_fold(spark, tmp_path):
    from stintlab.llm import queries

    rows = [(i, TAUGHT[x], x) for i, x in enumerate(("en", "de") * 8)] + [(None, TAUGHT["de"], "de")]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(16)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name in ("op10_language_id", "op5_quality"):
        held = {r["doc_id"]: r["held_out"] for r in queries.QUERIES[name](spark, str(tmp_path)).collect()}
        assert held[None] is False and None not in held.values() and True in held.values()


def test_words_scored_few_at_once(monkeypatch):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x" for i in range(60)]
    rules = langid.LanguageRules(buckets=64)
    table = np.arange(128, dtype=np.float32).reshape(64, 2)
    model = langid.LanguageModel(["a", "b"], table, np.ones((len(langid._NAMES), 2), bool), rules)
    whole, grams, seen = langid._word_scores(words, model), langid._grams, []
    monkeypatch.setattr(langid, "_grams", lambda codes, *rest: seen.append(len(codes)) or grams(codes, *rest))
    monkeypatch.setattr(langid, "_AT_ONCE", 7)
    assert all((a == b).all() for a, b in zip(whole, langid._word_scores(words, model))) and max(seen) == 7
