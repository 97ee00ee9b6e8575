import pytest
from pyspark.sql import functions as F

from stintlab.operators import baselines as B
from stintlab.operators.risk import add_risk_score
from stintlab.operators.slopes import add_degradation_slopes

BASE = (
    "year int, race_round int, compound string, tyre_age_bucket string, "
    "median_lap_time_sec double, median_pace_delta double, median_degradation_slope double, "
    "std_pace_delta double, std_degradation_slope double, sample_count long"
)


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame(
        [
            (2024, 1, "SOFT", "0-5", 90.0, 1.0, 0.1, 0.5, None, 9),
            (2024, 1, "SOFT", "6-10", 90.0, 3.0, 0.3, 0.7, 0.2, 2),
            (2024, 1, "HARD", "0-5", 90.0, 5.0, 0.5, 0.9, 0.4, 3),
            (2024, 2, "HARD", "0-5", 90.0, 7.0, 0.7, 1.1, 0.6, 4),
            (2024, 2, None, "0-5", 90.0, 11.0, 1.1, 1.3, 0.8, 99),
        ],
        BASE,
    )


def chosen(spark, base, key):
    df = spark.createDataFrame(
        [(*key, 10.0, 1.0)],
        "year int, race_round int, compound string, tyre_age_bucket string, "
        "pace_delta double, degradation_slope_5 double",
    )
    return B.attach_baselines(df, base).first()


def test_own_group_when_large_enough(spark, base):
    row = chosen(spark, base, (2024, 1, "SOFT", "0-5"))
    assert row.baseline_pace_delta == 1.0 and row.compound_baseline_delta == 9.0
    # A null at a passing tier falls through, here to race and compound.
    assert row.baseline_std_degradation_slope == pytest.approx(0.2)


def test_race_and_compound(spark, base):
    assert chosen(spark, base, (2024, 1, "SOFT", "6-10")).baseline_pace_delta == 2.0
    assert chosen(spark, base, (2024, 1, "SOFT", None)).baseline_pace_delta == 2.0


def test_compound_and_age(spark, base):
    assert chosen(spark, base, (2024, 1, "HARD", "0-5")).baseline_pace_delta == 6.0


def test_everything_and_unknown_compound(spark, base):
    mean = (1 + 3 + 5 + 7 + 11) / 5
    assert chosen(spark, base, (2024, 3, "WET", "0-5")).baseline_pace_delta == pytest.approx(mean)
    assert chosen(spark, base, (2024, 2, None, "0-5")).baseline_pace_delta == pytest.approx(mean)


def test_slopes_keep_gaps_and_need_enough_laps(spark):
    laps = [(1, True), (2, True), (3, False), (4, True), (5, True)]
    rows, seen = [], 0
    for n, clean in laps:
        seen += clean
        rows.append((2024, 1, "A", 1, n, n, clean, seen, 80.0 + n * n if clean else 200.0))
    rows += [(2024, 1, "B", 1, n, n, True, n, 90.0) for n in (1, 2)]
    df = spark.createDataFrame(
        rows,
        "year int, race_round int, driver_code string, stint long, lap_number long, "
        "stint_lap_number long, clean_lap boolean, clean_laps_in_stint_so_far long, "
        "lap_time_sec double",
    )
    got = {(r.driver_code, r.lap_number): r for r in add_degradation_slopes(df).collect()}
    # Clean laps 1, 2, 4: least squares through (1, 81), (2, 84), (4, 96).
    assert got["A", 4].degradation_slope_3 == pytest.approx(36 / 7)
    assert got["A", 3].degradation_slope_3 is None
    assert got["A", 5].degradation_slope_5 is None
    assert all(got["B", n].degradation_slope_3 is None for n in (1, 2))


RISK = (
    "compound_baseline_delta double, baseline_std_pace_delta double, "
    "compound_baseline_slope double, baseline_std_degradation_slope double, "
    "field_delta double, field_std_pace_delta double, clean_laps_in_stint_so_far long"
)


def test_risk_status(spark):
    df = spark.createDataFrame(
        [
            (1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 3),
            (1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 2),
            (1.0, 1.0, 0.0, 1.0, 0.0, 1.0, 3),
            (0.5, 1.0, 0.0, 1.0, 0.0, 1.0, 3),
            (0.0, 1.0, None, 1.0, 0.0, 1.0, 3),
            (None, None, None, None, None, None, None),
        ],
        RISK,
    ).coalesce(1)
    got = [(r.risk_status, r.risk_score) for r in add_risk_score(df).collect()]
    assert [s for s, _ in got] == [
        "HIGH", "INSUFFICIENT_DATA", "MEDIUM", "LOW", "MEDIUM", "LOW",
    ]
    assert [v for _, v in got] == pytest.approx([1.0, 1.0, 0.4, 0.2, 0.4, 0.0])
    zero = [r.risk_score for r in add_risk_score(df, null_component="zero").collect()]
    assert zero[4] == 0.0


def test_statistics_in_one_pass_equal_separate_ones(spark):
    df = spark.range(400).select(
        F.lit(2024).alias("year"), (F.col("id") % 2).cast("int").alias("race_round"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("C"), F.col("id") % 3)).alias("compound"),
        F.when(F.col("id") % 7 > 0, F.lit("0-5")).alias("tyre_age_bucket"),
        (F.col("id") % 20).alias("lap_number"), (F.col("id") % 4 > 0).alias("clean_lap"),
        (90 + F.col("id") % 13).cast("double").alias("lap_time_sec"),
        (F.col("id") % 17).cast("double").alias("pace_delta"),
        (F.col("id") % 19).cast("double").alias("degradation_slope_5"),
    )
    from tests.conftest import rows

    base, field = B.lap_statistics(df)
    want = B.compound_age_baselines(df)
    assert rows(base, *want.columns) == rows(want)
    alone = B.field_baselines(df)
    known = alone.filter("field_median_pace_delta IS NOT NULL")
    assert rows(field, *alone.columns) == rows(known)
