import numpy as np
import pytest

from stintlab.llm.quality import FEATURES, QualityRules, fit_nnpu, score_quality, text_features, train_quality
from tests.llm.tables import ODD_ROWS, docs, with_extra_columns

DATA = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_features_are_finite_for_any_text(rng):
    texts = [None, "", " ", "\n\n", "a", "!!!", "x" * 10_000, "日本 😀", "".join(chr(rng.randrange(1, 0xD7FF)) for _ in range(500))]
    for t in texts:
        values = text_features(t)
        assert len(values) == len(FEATURES) and np.isfinite(values).all()


def test_risk_finds_the_class_it_never_saw(rng):
    """Unlabelled points are 70 % like the positives; the rest lie elsewhere."""
    draw = np.random.default_rng(3)
    k = len(FEATURES)
    positive, hidden = draw.normal(0, 1, (2000, k)), draw.normal(3, 1, (600, k))
    unlabelled = np.concatenate([draw.normal(0, 1, (1400, k)), hidden])
    model = fit_nnpu(positive, unlabelled, 0.7)
    assert (model.score(positive) >= 0.5).mean() > 0.97
    assert (model.score(hidden) < 0.3).mean() > 0.9


def test_without_samples_the_prior_is_the_score():
    empty = np.zeros((0, len(FEATURES)))
    assert np.allclose(fit_nnpu(empty, empty, 0.6).score(np.array([text_features("some text")])), 0.6)


def test_held_out_accuracy(spark):
    import __spark_entry__ as entry

    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = [r for r in entry.queries()["op5_quality"](spark, DATA).collect() if r["doc_id"] in truth]
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.93
    good, bad = ([r["score"] for r in held if truth[r["doc_id"]] == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.98


def test_same_model_under_any_partitioning(spark):
    table = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    known = spark.read.parquet(f"{DATA}/labels.parquet")
    rules = QualityRules(sample_rows=100, steps=50)
    first, second = (train_quality(t, known, rules) for t in (table, table.repartition(7)))
    assert np.array_equal(first.weights, second.weights) and first.bias == second.bias


@pytest.mark.parametrize("known", [[], [(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0)]])
def test_awkward_rows_and_empty_tables(spark, known):
    table = with_extra_columns(docs(spark, ODD_ROWS))
    model = train_quality(table.select("doc_id", "text"), labels(spark, known), QualityRules(steps=5))
    got = score_quality(table, model).collect()
    assert len(got) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert score_quality(table.limit(0), model).count() == 0
