"""The blocked forms give what the plain window gives, whatever the shape of the groups."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stintlab.config import Scale
from stintlab.operators import laps as L
from stintlab.operators import live
from stintlab.operators.ordered import blocked_running, ranked, split_hot
from stintlab.operators.slopes import add_degradation_slopes
from stintlab.operators.weather import attach_weather
from stintlab.plans import batch, lap_view
from tests.conftest import rows

PLAIN = Scale()
KEY = ["year", "race_round", "driver_code", "stint", "lap_number"]


def one_stint_laps(spark, n=120, seed=1):
    """A corpus where one stint, with unknown stint number, holds most rows."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        hot = i % 3 != 0
        out.append(
            (
                2024, 1, "D1" if hot else f"D{i % 7}", None if hot else 1, i + 1,
                None if i % 11 == 0 else 90 + rng.random(), None if i % 13 else 1.0, None,
                i % 9 != 0, "1", "SOFT", float(i % 25), float(i * 90), "HIGH" if i % 5 else "LOW",
            )
        )
    return spark.createDataFrame(
        out,
        "year int, race_round int, driver_code string, stint long, lap_number long, "
        "lap_time_sec double, pit_in_time double, pit_out_time double, is_accurate boolean, "
        "track_status string, compound string, tyre_life double, lap_start_time_sec double, "
        "risk_status string",
    ).repartition(5)


@pytest.fixture(scope="module")
def hot_laps(spark):
    return L.add_clean_lap(one_stint_laps(spark))


def close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == pytest.approx(y, abs=1e-9), (x, y)


def test_only_large_groups_are_split(spark, hot_laps, tight):
    ordinary, hot = split_hot(hot_laps, ["driver_code", "stint"], tight)
    assert hot.count() == 80 and ordinary.count() == 40
    assert split_hot(hot_laps, ["lap_number"], tight)[1] is None
    assert split_hot(hot_laps, ["driver_code"], PLAIN)[1] is None


def test_stint_windows(spark, hot_laps, tight):
    columns = KEY + [
        "stint_lap_number", "clean_laps_in_stint_so_far", "rolling_3_lap_avg",
        "rolling_5_lap_avg", "previous_5_lap_avg", "pace_delta",
    ]
    plain = rows(L.add_stint_windows(hot_laps, PLAIN), *columns)
    close(rows(L.add_stint_windows(hot_laps, tight), *columns), plain)
    steps = L.add_rolling_pace(L.add_stint_counters(hot_laps, tight), tight)
    close(rows(steps, *columns), plain)


def test_slopes(spark, hot_laps, tight):
    known = hot_laps.fillna({"stint": 9})
    table = L.add_stint_windows(known, PLAIN)
    columns = KEY + ["degradation_slope_3", "degradation_slope_5"]
    plain = rows(add_degradation_slopes(table, PLAIN), *columns)
    assert sum(r[-1] is not None for r in plain) > 20
    close(rows(add_degradation_slopes(table, tight), *columns), plain)


def test_unknown_stint_has_no_slope(spark, hot_laps):
    table = L.add_stint_windows(hot_laps, PLAIN)
    got = add_degradation_slopes(table, PLAIN).filter("stint IS NULL")
    assert got.filter("degradation_slope_3 IS NOT NULL").isEmpty()


def test_runs_of_high(spark, hot_laps, tight):
    columns = KEY + ["consecutive_high"]
    plain = rows(live.add_consecutive_high(hot_laps, PLAIN), *columns)
    assert max(r[-1] for r in plain) >= 3
    assert rows(live.add_consecutive_high(hot_laps, tight), *columns) == plain


def test_copies_of_one_row_are_ranked_apart(spark, tight):
    same = spark.range(0, 50, 1, 4).select(F.lit("a").alias("k"), F.lit(1).alias("o"))
    few = spark.range(3).select(F.lit("b").alias("k"), F.col("id").cast("int").alias("o"))
    df = same.unionByName(few)
    got = ranked(df, ["k"], ["o"], "n", tight)
    assert rows(got.filter("k = 'a'"), "n") == sorted([(i,) for i in range(1, 51)], key=repr)
    assert rows(got.filter("k = 'b'"), "o", "n") == [(0, 1), (1, 2), (2, 3)]


def test_rank_in_many_blocks(spark, tight):
    df = spark.range(0, 300, 1, 6).select(
        (F.col("id") % 2).alias("k"), F.hash("id").alias("o"), F.col("id")
    )
    w = Window.partitionBy("k").orderBy("o")
    plain = df.withColumn("n", F.row_number().over(w).cast("bigint"))
    assert rows(ranked(df, ["k"], ["o"], "n", tight)) == rows(plain)


def test_whole_batch_plan(spark, data, tight):
    """Scores of the full corpus with every limit low equal those of the plain plan."""
    laps = lap_view.laps_of(lap_view.read(spark, data, "events"))
    columns = KEY + ["risk_score", "risk_status", "field_delta", "driver_vs_field_delta"]
    plain = rows(batch.score_laps(laps, scale=PLAIN).events, *columns)
    low = Scale(small_bytes=0, hot_rows=14, block_rows=6, broadcast_rows=2)
    close(rows(batch.score_laps(laps, scale=low).events, *columns), plain)


def test_weather_with_low_limits(spark, data, tight):
    events = lap_view.read(spark, data, "events")
    laps, weather = lap_view.laps_of(events), lap_view.weather_of(events)
    columns = KEY + ["air_temp_c", "wind_direction", "rainfall"]
    plain = rows(attach_weather(laps, weather, PLAIN), *columns)
    assert rows(attach_weather(laps, weather, tight), *columns) == plain


def test_running_values_in_blocks(spark, tight):
    """Sum, max, xor and last known value by block equal the plain window, nulls included."""
    rng = random.Random(9)
    data = [(g, i + 1, rng.choice([None, None, rng.randrange(100)])) for g in (None, 1) for i in range(60)]
    table = spark.createDataFrame(data, "g long, at long, v long").repartition(5)
    kinds = {"sum": F.sum("v"), "max": F.max("v"), "xor": F.bit_xor("v"), "last": F.last("v", ignorenulls=True)}
    w = Window.partitionBy("g").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    want = table.withColumns({k: agg.over(w) for k, agg in kinds.items()})
    got = blocked_running(table, ["g"], "at", {k: (k, F.col("v")) for k in kinds}, tight)
    assert rows(got) == rows(want)
