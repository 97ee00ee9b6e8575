"""Medians of groups of any size are elements of the data at the exact rank."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from stintlab.config import Scale
from stintlab.operators import baselines, laps
from stintlab.operators.quantiles import group_medians, grouping_number
from tests.conftest import rows

PLAIN, LOW = Scale(), Scale(small_bytes=0, hot_rows=20, block_rows=50, broadcast_rows=2)


def middle(values):
    known = sorted(v for v in values if v is not None)
    return known[math.ceil(len(known) / 2) - 1] if known else None


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, a null group, repeated values, unknown values."""
    rng = random.Random(6)
    data = []
    for i in range(9000):
        a = "hot" if i % 3 == 0 else rng.choice(["b", "c", None, "few"])
        if a == "few" and rng.random() < 0.99:
            a = "b"
        x = None if rng.random() < 0.05 else rng.choice([rng.gauss(0, 1), float(rng.randrange(5))])
        data.append((a, rng.randrange(3), x, None if a == "c" else rng.uniform(0, 1e6)))
    return data, spark.createDataFrame(data, "a string, b int, x double, y double").repartition(6)


@pytest.mark.parametrize("scale", [PLAIN, LOW])
@pytest.mark.parametrize("sketch", [40, 1000])
def test_medians_of_many_groupings(skewed, scale, sketch):
    data, df = skewed
    groups = [["a", "b"], ["b"], ["a"]]
    got = group_medians(df, groups, {"mx": "x", "my": "y"}, [F.count("*").alias("n")], scale, sketch).collect()
    want = {}
    for group in groups:
        for a, b, x, y in data:
            key = (grouping_number(group, ["a", "b"]), a if "a" in group else None, b if "b" in group else None)
            own = want.setdefault(key, ([], []))
            own[0].append(x)
            own[1].append(y)
    assert {(r["_grouping"], r["a"], r["b"]): (r["mx"], r["my"], r["n"]) for r in got} == {
        k: (middle(x), middle(y), len(x)) for k, (x, y) in want.items()
    }


def test_large_groups_equal_sql(spark, tmp_path):
    """Groups far above what a sketch holds exactly, one of them with a third of the rows."""
    path = str(tmp_path / "laps")
    spark.range(0, 180_000, 1, 8).select(
        F.lit(2024).alias("year"), F.when(F.col("id") % 3 == 0, 1).otherwise(2 + F.col("id") % 4).cast("int").alias("race_round"),
        F.lit(7).cast("long").alias("lap_number"), (F.xxhash64("id") % 1_000_003 / 1000.0).alias("lap_time_sec"),
        (F.col("id") % 11 > 0).alias("clean_lap"),
    ).write.parquet(path)
    table = spark.read.parquet(path)
    got = {r["race_round"]: r["field_median_lap_time"] for r in laps.field_medians(table).collect()}
    want = duckdb.sql(
        f"SELECT race_round, quantile_disc(lap_time_sec, 0.5) FILTER (clean_lap) FROM '{path}/*.parquet' GROUP BY 1"
    ).fetchall()
    assert got == dict(want)


def test_empty_and_unknown_groups(spark):
    empty = spark.createDataFrame([], "a string, x double")
    assert group_medians(empty, [["a"]], {"m": "x"}, []).count() == 0
    unknown = spark.createDataFrame([("k", None)] * 50, "a string, x double")
    assert group_medians(unknown, [["a"]], {"m": "x"}, [], sketch=10).first()["m"] is None


def test_baselines_do_not_depend_on_the_sketch(spark, data, monkeypatch):
    from stintlab.operators import quantiles
    from stintlab.plans import batch, lap_view
    from stintlab.sources.tables import stage

    table = stage(batch.stint_table(lap_view.laps_of(lap_view.read(spark, data, "events"))))
    columns = [*baselines.BASELINE_KEYS, *[n for n, kind, _ in baselines.MEASURES if kind == "median"]]
    plain = rows(baselines.compound_age_baselines(table), *columns)
    monkeypatch.setattr(quantiles.group_medians, "__defaults__", (quantiles.SCALE, 8))
    assert rows(baselines.compound_age_baselines(table), *columns) == plain
