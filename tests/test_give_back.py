"""Workers that score give back what earlier tasks freed."""

from pyspark.sql import functions as F

from stintlab.llm import langid, vocab
from stintlab.operators import forest
from stintlab.plans import catalog
from stintlab.sources import shipping


def test_scoring_gives_memory_back(spark, monkeypatch):
    made = []
    monkeypatch.setattr(forest.F, "pandas_udf", lambda kind: lambda f: made.append(f) or (lambda *columns: columns))
    forest.raw_score(catalog.hand_forest(spark))
    calls = []
    monkeypatch.setattr(forest, "give_back", lambda: calls.append(1))
    assert list(made[0](iter([]))) == [] and calls == [1]


def test_a_task_leaves_no_caches_behind(monkeypatch):
    """What another operator's tasks kept in the worker goes when a task starts, and its own when it ends."""
    given = []
    monkeypatch.setattr(shipping, "_kept", [])
    monkeypatch.setattr(shipping.gc, "collect", lambda: given.append(1))
    other, own = (shipping.kept_in_worker(maxsize=8)(lambda x: [x]) for _ in range(2))
    other(1), own(1)
    sizes = lambda: (other.cache_info().currsize, own.cache_info().currsize)
    during = list(shipping.lean(lambda batches: (sizes() for _ in batches), own)([1]))
    assert during == [(0, 1)] and sizes() == (0, 1) and len(given) == 2
    assert list(shipping.lean(lambda batches: (own(2) for _ in batches))([1])) == [[2]]
    assert sizes() == (0, 0)


def test_language_tasks_let_the_encoder_go(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "some plain words", "en") for i in range(20)], "doc_id long, text string, lang string")
    begun = []
    monkeypatch.setattr(langid, "lean", lambda task, *keep: begun.append(keep) or shipping.lean(task, *keep))
    model = langid.train_languages(docs, F.lit(True))
    assert langid.predict_languages(docs, model).count() == 20 and langid.keep_identified(docs, model).count() == 20
    assert begun == [(), (), ()]
    assert vocab.byte_encoder in shipping._kept and langid._pieces in shipping._kept
