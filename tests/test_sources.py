import pytest
from pyspark.sql import functions as F

from stintlab.operators.weather import attach_weather
from stintlab.plans import batch, lap_view, serving
from stintlab.schemas import require
from stintlab.sources import laps as store
from stintlab.sources import replay
from stintlab.sources.tables import path_exists, write_table
from tests.conftest import rows


@pytest.fixture(scope="module")
def raw(spark):
    events = lap_view.read(spark, "/root/testdata/sf0.01", "events").filter("user_id < 60")
    laps = attach_weather(lap_view.laps_of(events), lap_view.weather_of(events))
    return laps.drop("event_id").cache()


def races(spark, root):
    return rows(store.existing_races(spark, root), "year", "race_round")


def test_partitioned_round_trip(spark, raw, tmp_path):
    root = str(tmp_path / "laps")
    store.write_raw_laps(raw, root)
    back = store.read_raw_laps(spark, root)
    assert dict(back.dtypes)["year"] == "int" and dict(back.dtypes)["round"] == "int"
    assert back.filter("round <> race_round").isEmpty()
    assert rows(back.select(*raw.columns)) == rows(raw)
    assert path_exists(spark, store.partition_path(root, 2024, 3))
    scan = back.filter("round = 2").select("lap_number")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(round" in scan


def test_only_given_races_are_replaced(spark, raw, tmp_path):
    root = str(tmp_path / "laps")
    store.write_raw_laps(raw, root)
    store.write_raw_laps(raw.filter("race_round = 2").limit(5), root)
    sizes = {r.round: r["count"] for r in store.read_raw_laps(spark, root).groupBy("round").count().collect()}
    assert sizes[2] == 5 and sizes[1] == raw.filter("race_round = 1").count()


def test_skip_existing(spark, raw, tmp_path):
    root = str(tmp_path / "laps")
    assert races(spark, root) == []
    store.ingest(raw.filter("race_round = 1"), root)
    changed = raw.withColumn("race_name", F.lit("changed"))
    store.ingest(changed, root, skip_existing=True)
    assert races(spark, root) == [(2024, 1), (2024, 2), (2024, 3)]
    names = store.read_raw_laps(spark, root).filter("race_name <> 'changed'").select("round").distinct()
    assert rows(names) == [(1,)]


def test_sweep(spark, raw, tmp_path):
    root = str(tmp_path / "laps")
    store.ingest(raw.filter("race_round = 1"), root)
    schedule = spark.createDataFrame(
        [(2024, 0, "Testing"), (2024, 1, "Race 1"), (2024, 2, "Race 2"), (2024, 9, "Race 9")],
        "year int, round int, race_name string",
    )
    counts = store.sweep(schedule, raw, root)
    assert rows(counts) == [("failed", 1), ("skipped", 1), ("written", 1)]
    assert races(spark, root) == [(2024, 1), (2024, 2)]
    again = store.sweep(schedule, raw, root, skip_existing=False)
    assert rows(again) == [("failed", 1), ("written", 2)]
    assert rows(store.corpus_by_year(store.read_raw_laps(spark, root)), "year", "races") == [(2024, 2)]


def test_a_race_with_a_bad_value_fails_alone(spark, raw, tmp_path):
    root = str(tmp_path / "laps")
    bad = raw.withColumn(
        "tyre_life", F.when((F.col("race_round") == 2) & (F.col("lap_number") == 3), "old").otherwise(F.col("tyre_life").cast("string"))
    )
    schedule = spark.createDataFrame([(2024, n, f"Race {n}") for n in (1, 2, 3)], "year int, round int, race_name string")
    assert rows(store.sweep(schedule, bad, root)) == [("failed", 1), ("written", 2)]
    assert races(spark, root) == [(2024, 1), (2024, 3)]


def test_a_race_that_cannot_be_computed_fails_alone(spark, raw, tmp_path):
    """A fault in one race leaves the others published, and what was stored of it before stays."""
    root = str(tmp_path / "laps")
    store.ingest(raw.filter("race_round = 2").limit(4), root)
    fault = F.when((F.col("race_round") == 2) & (F.col("lap_number") == 3), F.raise_error(F.lit("broken lap")).cast("double"))
    broken = raw.withColumn("lap_time_sec", fault.otherwise(F.col("lap_time_sec")))
    schedule = spark.createDataFrame([(2024, n, f"Race {n}") for n in (1, 2, 3, 4)], "year int, round int, race_name string")
    assert rows(store.sweep(schedule, broken, root, skip_existing=False)) == [("failed", 2), ("written", 2)]
    stored = store.read_raw_laps(spark, root)
    sizes = {r.round: r["count"] for r in stored.groupBy("round").count().collect()}
    assert sizes == {1: raw.filter("race_round = 1").count(), 2: 4, 3: raw.filter("race_round = 3").count()}
    status = {r.race_round: (r.status, r.reason) for r in store.sweep_status(spark, root).collect()}
    assert status[1] == status[3] == ("written", None) and status[4] == ("failed", "no laps")
    assert status[2][0] == "failed" and "broken lap" in status[2][1]
    again = store.sweep(schedule, raw, root, skip_existing=False)
    assert rows(again) == [("failed", 1), ("written", 3)]
    assert store.read_raw_laps(spark, root).count() == raw.count()
    assert store.sweep_status(spark, root).select("run").distinct().count() == 2


def test_inventory_reads_no_data_column(spark, raw, tmp_path):
    root = str(tmp_path / "laps")
    assert store.race_counts(spark, root).count() == 0
    store.write_raw_laps(raw, root)
    text = store._footer_counts(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in text and "PushedGroupBy: [year, round]" in text
    want = raw.groupBy("year", "race_round").agg(F.count("*"))
    assert rows(store.race_counts(spark, root)) == rows(want)
    assert rows(store.stored_by_year(spark, root)) == rows(store.corpus_by_year(raw))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_messages_of_a_driver_stay_in_lap_order(spark):
    sent = spark.range(0, 3000, 1, 9).select(
        (F.hash("id") % 400).cast("long").alias("lap_number"), F.concat(F.lit("D"), F.col("id") % 7).alias("key"), F.lit("v").alias("value")
    )
    laid = replay.by_driver(sent).withColumns({"task": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    seen = {}
    for r in sorted(laid.collect(), key=lambda r: r["place"]):
        assert seen.get(r["key"], (r["task"], r["lap_number"])) <= (r["task"], r["lap_number"])
        assert seen.get(r["key"], (r["task"], 0))[0] == r["task"]
        seen[r["key"]] = (r["task"], r["lap_number"])


def test_a_very_large_driver_is_sent_range_by_range(spark):
    """Parts in order hold each driver's laps in order, every message once, and bounded work per driver."""
    hot = [("H", n) for n in range(500)] + [("H", None), ("H", 7), ("H", 7)]
    rest = [(f"D{d}", n) for d in range(5) for n in range(30)]
    sent = spark.createDataFrame(hot + rest, "key string, lap_number long").withColumn("value", F.lit("v")).repartition(6)
    assert len(replay.lap_ranges(sent, 1000)) == 1
    parts = [[(r["key"], r["lap_number"]) for r in p.collect()] for p in replay.lap_ranges(sent, 60)]
    assert 8 <= len(parts) <= 18
    assert sorted(sum(parts, []), key=repr) == sorted(hot + rest, key=repr)
    laps = [[-1 if n is None else n for _, n in p] for p in parts]
    assert all(max(a) < min(b) for a, b in zip(laps, laps[1:]))
    assert max(sum(k == "H" for k, _ in p) for p in parts) <= 60 + 3


def test_resolve(spark, raw, tmp_path):
    root, single = str(tmp_path / "laps"), str(tmp_path / "laps.parquet")
    with pytest.raises(FileNotFoundError):
        store.resolve_laps(spark, root, single)
    write_table(raw.limit(3), single)
    assert store.resolve_laps(spark, root, single) == single
    store.write_raw_laps(raw.limit(3), root)
    assert store.resolve_laps(spark, root, single) == root


def test_required_columns(raw):
    with pytest.raises(ValueError, match="nothing"):
        require(raw, ["year", "nothing"], "laps")


def test_race_filter(raw):
    assert replay.filter_race(raw, "2024 Race 2").select("race_round").distinct().first()[0] == 2
    assert replay.filter_race(raw, "Race 3").select("race_round").distinct().first()[0] == 3
    assert replay.filter_race(raw, "2023 Race 2", must_exist=False).isEmpty()
    with pytest.raises(ValueError):
        replay.filter_race(raw, "Race 99")


def test_messages_and_parsing(spark):
    texts = [
        '{"driver_code": "A", "stint": 2, "lap_time_sec": 90.5, "rainfall": true}',
        "not json",
        None,
        '{"driver_code": "B", "stint": 1.0}',
        '{"stint": 1}',
        '{"driver_code": ""}',
    ]
    df = spark.createDataFrame([("k", t) for t in texts], "key string, value string")
    got = replay.parse_messages(df).select("driver_code", "stint", "lap_time_sec", "rainfall")
    assert rows(got) == [("A", 2, 90.5, True), ("B", None, None, None)]

    event = spark.createDataFrame(
        [("A", 3, float("nan"), 1.5)], "driver_code string, lap_number long, pace_delta double, risk_score double"
    )
    sent = replay.replay_messages(event, event_time="t").first()
    assert sent.key == "A"
    assert sent.value == (
        '{"driver_code":"A","lap_number":3,"pace_delta":null,"risk_score":1.5,"event_time":"t"}'
    )


def test_batch_job_end_to_end(spark, raw, tmp_path):
    at = batch.Layout.under(str(tmp_path))
    store.write_raw_laps(raw, at.raw)
    batch.write_features(spark, at)
    first = batch.write_events(spark, at)
    assert first.filter("anomaly_score IS NOT NULL OR is_anomaly").isEmpty()
    forest = batch.write_model(spark, at)
    assert forest.trained_rows >= 100
    events = batch.write_events(spark, at)
    assert events.count() == raw.count()
    assert set(replay.PAYLOAD_FIELDS) <= set(events.columns)
    flagged = events.filter("is_anomaly").count()
    assert 0 < flagged and events.filter("is_anomaly AND anomaly_score IS NULL").isEmpty()

    # The stored and the fused form of the plan agree.
    fused = batch.score_laps(raw).events
    columns = ["driver_code", "lap_number", "risk_status", "stint_lap_number"]
    assert rows(fused, *columns) == rows(events, *columns)

    assert serving.register_views(spark, at.views()) == list(serving.VIEWS)
    for name in serving.REPORTS:
        assert not serving.run_report(spark, name).isEmpty()
    one = batch.write_events(spark, at, race="2024 Race 2")
    assert rows(one.select("race_round").distinct()) == [(2,)]
    assert batch.write_events(spark, at, race="2024 Nowhere").isEmpty()
    assert set(replay.PAYLOAD_FIELDS) <= set(spark.read.parquet(at.events).columns)


def test_views_without_events(spark, raw, tmp_path):
    paths = {v: str(tmp_path / v) for v in serving.VIEWS}
    write_table(raw.limit(2), paths["lap_features"])
    write_table(raw.limit(2), paths["baselines"])
    assert serving.register_views(spark, paths) == ["lap_features", "baselines"]
