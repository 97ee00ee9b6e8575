import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stintlab.config import Rules, Scale
from stintlab.operators import forest as M

INPUTS = M.ANOMALY_FEATURES
FAST = Rules(trees=40)


def table(spark, n=1500, parts=4):
    normal = [F.randn(i + 1).alias(c) for i, c in enumerate(INPUTS)]
    df = spark.range(0, n, 1, 1).select("id", F.lit(True).alias("clean_lap"), *normal)
    strange = F.when(F.col("id") % 100 == 0, F.col("pace_delta") + 12).otherwise(F.col("pace_delta"))
    return df.withColumn("pace_delta", strange).repartition(parts)


@pytest.fixture(scope="module")
def train(spark):
    return M.training_frame(table(spark)).cache()


@pytest.fixture(scope="module")
def forest(train):
    return M.fit_forest(train, rules=FAST, keys=["id"])


def test_description(forest):
    assert forest.features == INPUTS
    assert 0 < forest.contamination < 0.5
    assert forest.trained_rows == 1500 and forest.sample_size == 256
    assert forest.nodes.select("tree").distinct().count() == FAST.trees
    assert forest.nodes.agg(F.max("node")).first()[0] < 2 ** 9 - 1


def test_scores_and_rate(train, forest):
    got = M.score_events(train, forest).agg(
        F.min("anomaly_score").alias("low"), F.max("anomaly_score").alias("high"),
        F.count_if(F.col("anomaly_score").isNull()).alias("unknown"),
        F.avg(F.col("is_anomaly").cast("int")).alias("rate"),
    ).first()
    assert -1 < got.low < got.high < 0 and got.unknown == 0
    assert got.rate <= forest.contamination * 1.5 + 0.02
    assert got.rate == pytest.approx(forest.contamination, abs=0.005)


def test_outliers_score_lowest(train, forest):
    by = M.score_events(train, forest).groupBy((F.col("id") % 100 == 0).alias("odd"))
    mean = {r.odd: r.m for r in by.agg(F.avg("anomaly_score").alias("m")).collect()}
    assert mean[True] < mean[False] - 0.05


def test_same_forest_for_any_partitioning(spark, train, forest):
    again = M.fit_forest(train.repartition(3, "humidity"), rules=FAST, keys=["id"])
    assert again.offset == forest.offset
    assert again.nodes.exceptAll(forest.nodes).isEmpty()


def test_same_forest_under_any_limits(spark, train, forest, tight):
    again = M.fit_forest(train, rules=FAST, scale=tight, keys=["id"])
    assert again.offset == forest.offset
    assert again.nodes.exceptAll(forest.nodes).isEmpty()


def test_round_trip(spark, train, forest, tmp_path):
    assert M.load_forest(spark, str(tmp_path / "none")) is None
    forest.save(str(tmp_path / "m"))
    back = M.load_forest(spark, str(tmp_path / "m"))
    a = M.score_events(train, back).agg(F.sum("anomaly_score")).first()[0]
    b = M.score_events(train, forest).agg(F.sum("anomaly_score")).first()[0]
    assert a == pytest.approx(b) and back.offset == forest.offset


def test_unknown_inputs(spark, train, forest):
    with pytest.raises(ValueError):
        M._Walker(forest).score(np.full((1, len(INPUTS)), np.nan))
    holes = train.limit(4).withColumn("humidity", F.lit(None).cast("double"))
    holes = holes.unionByName(train.limit(4).withColumn("humidity", F.lit(math.nan)))
    got = M.score_events(holes, forest).select("anomaly_score", "is_anomaly").distinct().collect()
    assert [tuple(r) for r in got] == [(None, False)]


def test_missing_column_or_model(spark, train, forest):
    for df, model in ((train.drop("humidity"), forest), (train, None)):
        got = M.score_events(df, model).select("anomaly_score", "is_anomaly").distinct().collect()
        assert [tuple(r) for r in got] == [(None, False)]
    with pytest.raises(ValueError):
        M.training_frame(train.drop("humidity"))
    with pytest.raises(ValueError):
        M.fit_forest(train.limit(49), rules=FAST, keys=["id"])


def test_rows_are_judged_alike_at_any_size(spark):
    """Each tree gets its full sample whatever the number of rows, and equal rows weigh in full."""
    columns = ["a", "b"]
    for n in (300, 3000, 60_000):
        many = spark.range(n).select(
            "id", *[F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.rand(i)).alias(c) for i, c in enumerate(columns)]
        )
        drawn = M.draw_samples(many, columns, ["id"], n, 256, Rules(trees=30)).toPandas()
        assert (drawn.groupby("tree").size() == 256).all() and drawn["tree"].nunique() == 30
        assert (drawn[columns] == 0.0).all(axis=1).mean() == pytest.approx(1 / 3, abs=0.05)


def test_exact_quantiles(spark, tight):
    from stintlab.operators.quantiles import exact_quantiles

    points = [0.0, 0.05, 0.3, 0.5, 0.999, 1.0]
    draw = np.random.default_rng(1)
    for values in (list(range(10)), [1.5], [2.0] * 30 + [1.0], list(np.round(draw.normal(size=200), 1))):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(5)
        for scale in (Scale(), tight):
            assert exact_quantiles(df, "x", points, scale) == pytest.approx(list(np.quantile(values, points)))
    assert exact_quantiles(df.filter("x IS NULL"), "x", [0.5]) == [None]
