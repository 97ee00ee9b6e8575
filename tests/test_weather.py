from pyspark.sql import functions as F

from stintlab.operators.weather import attach_weather, project_weather, without_weather

MEASURES = (
    "air_temp_c double, track_temp_c double, humidity double, pressure double, "
    "rainfall boolean, wind_speed double, wind_direction double"
)


def weather(spark, points):
    full = [(2024, r, t, a, 1.0, 2.0, 3.0, False, 4.0, 5.0) for r, t, a in points]
    return spark.createDataFrame(full, f"year int, race_round int, t_sec double, {MEASURES}")


def laps(spark, points):
    return spark.createDataFrame(
        [(2024, r, i, t) for i, (r, t) in enumerate(points)],
        "year int, race_round int, id int, lap_start_time_sec double",
    )


def attached(spark, lap_points, sample_points):
    out = attach_weather(laps(spark, lap_points), weather(spark, sample_points))
    return [r.air_temp_c for r in out.orderBy("id").collect()]


def test_backward_with_exact_match(spark):
    got = attached(
        spark,
        [(1, 5.0), (1, 10.0), (1, 15.0), (1, 20.0), (1, None), (2, 15.0)],
        [(1, 10.0, 1.0), (1, 20.0, 2.0)],
    )
    assert got == [None, 1.0, 1.0, 2.0, None, None]


def test_sample_carries_over_empty_buckets(spark):
    got = attached(
        spark,
        [(1, 59.9), (1, 60.0), (1, 3000.0), (1, 9000.0), (1, 9001.0), (2, 100.0)],
        [(1, 30.0, 1.0), (1, 9000.5, 2.0), (2, 0.0, 7.0)],
    )
    assert got == [1.0, 1.0, 1.0, 1.0, 2.0, 7.0]


def test_negative_times_and_repeated_instants(spark):
    got = attached(spark, [(1, -70.0), (1, -10.0)], [(1, -100.0, 3.0), (1, -10.0, 4.0), (1, -10.0, 5.0)])
    assert got == [3.0, 5.0]


def test_project_and_missing_weather(spark):
    raw = spark.createDataFrame(
        [(2024, 1, 1, 20, 30, True)],
        "year int, race_round int, t_sec int, AirTemp int, TrackTemp int, Rainfall boolean",
    )
    row = project_weather(raw).first()
    assert row.air_temp_c == 20.0 and row.rainfall is True and row.humidity is None
    types = dict(without_weather(laps(spark, [(1, 1.0)])).dtypes)
    assert types["rainfall"] == "boolean" and types["air_temp_c"] == "double"
    assert dict(project_weather(raw).dtypes)["humidity"] == "double"


def test_one_session_holding_all_rows_is_carried_in_blocks(spark, tight):
    """Sparse samples over thousands of buckets of one session, against a search in sorted order."""
    import bisect
    import random

    rng = random.Random(2)
    samples = sorted({round(rng.uniform(0, 200_000), 1) for _ in range(90)})
    starts = [rng.uniform(-500, 220_000) for _ in range(900)]
    points = weather(spark, [(1, t, float(i)) for i, t in enumerate(samples)])
    table = laps(spark, [(1, t) for t in starts]).repartition(5)
    got = {r.id: r.air_temp_c for r in attach_weather(table, points, tight).collect()}
    for i, t in enumerate(starts):
        place = bisect.bisect_right(samples, t) - 1
        assert got[i] == (None if place < 0 else float(place))


def test_large_sessions_meet_in_no_window(spark, tight):
    from stintlab.operators.weather import carried_measures

    buckets = spark.range(0, 400, 1, 4).select(
        F.lit(2024).alias("year"), F.lit(1).alias("race_round"), F.col("id").alias("bucket"),
        F.when(F.col("id") % 37 == 5, F.struct(F.col("id").alias("v"))).alias("newest"),
    )
    out = carried_measures(buckets, tight)
    got = {r.bucket: r.measures and r.measures.v for r in out.collect()}
    assert got == {b: max((v for v in range(5, b, 37)), default=None) for b in range(400)}
    # Buckets are in windows per block, apart from the one row per block that is carried.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    over_buckets = [line for line in plan.splitlines() if "Window [" in line and "_in_measures" in line]
    assert over_buckets and all("_block" in line for line in over_buckets)
