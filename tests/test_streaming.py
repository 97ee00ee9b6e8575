import numpy as np
import pytest
from pyspark.sql import functions as F

from stintlab.operators import live
from stintlab.sources import replay
from stintlab.streaming.lap_order import run_lengths
from stintlab.streaming.live_log import FAN
from stintlab.streaming.monitor import LiveTables, start_monitor, write_batch
from tests.conftest import rows

EVENT = (
    "year int, race_round int, race_name string, driver_code string, lap_number long, "
    "compound string, stint long, clean_lap boolean, lap_time_sec double, tyre_life double, "
    "pace_delta double, risk_score double, risk_status string, anomaly_score double, "
    "is_anomaly boolean, rainfall boolean, degradation_slope_5 double, constructor_key string, "
    "field_delta double, air_temp_c double, track_temp_c double, humidity double, wind_speed double"
)


def event(driver, lap, high=True, clean=True, risk=0.75, odd=False, time=90.0):
    return (
        2024, 1, "Race 1", driver, lap, "SOFT", None if lap == 3 else 1, clean, time, 2.0, 0.5, risk,
        "HIGH" if high else "LOW", -0.4, odd, False, 0.1, "team", 0.1, 20.0, 30.0, 40.0, 1.0,
    )


class Feed:
    """Message folders that arrive one after the other, and a monitor over them."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.tables = LiveTables(spark, f"{self.root}/tables")

    def send(self, events, event_time="2024-03-02T15:00:00+00:00"):
        df = self.spark.createDataFrame(events, EVENT).coalesce(1)
        sent = replay.replay_messages(df, event_time=event_time)
        sent.write.mode("append").parquet(f"{self.root}/in")

    def beat(self, at):
        replay.heartbeat(self.spark, at).coalesce(1).write.mode("append").parquet(f"{self.root}/in")

    def drain(self, **options):
        source = replay.file_source(self.spark, f"{self.root}/in")
        run = start_monitor(
            source, self.tables, f"{self.root}/checkpoint", drain=True, **options
        )
        run.awaitTermination()

    def run_of(self, driver):
        state = self.tables.state().filter(F.col("driver_code") == driver).first()
        return state.lap_number, state.consecutive_high


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_run_lengths():
    up = np.array([1, 1, 0, 1, 1, 1], dtype=bool)
    assert run_lengths(up, 0).tolist() == [1, 2, 0, 1, 2, 3]
    assert run_lengths(up, 4).tolist() == [5, 6, 0, 1, 2, 3]
    assert run_lengths(~up, 4).tolist() == [0, 0, 1, 0, 0, 0]


FLAGS = [1, 1, 0, 1, 1, 1]


def test_counter_within_across_and_after_restart(feed):
    laps = [event("A", i + 1, high=bool(f)) for i, f in enumerate(FLAGS)]
    feed.send([laps[1], laps[0]])
    feed.drain()
    assert feed.run_of("A") == (2, 2)
    feed.send(laps[2:5])
    feed.drain()
    assert feed.run_of("A") == (5, 2)
    feed.send(laps[5:])
    feed.drain()
    assert feed.run_of("A") == (6, 3)


def test_stream_equals_batch(spark, feed):
    events = [
        event(d, lap, high=(lap * k) % 4 > 0, clean=lap % 5 > 0, odd=lap % 3 == 0, risk=0.1 * (lap % 9))
        for k, d in enumerate(["A", "B", "C"], start=1)
        for lap in range(1, 13)
    ]
    for low in (1, 5, 9):
        feed.send([e for e in events if low <= e[4] < low + 4])
        feed.drain()
    whole = live.add_consecutive_high(spark.createDataFrame(events, EVENT))
    want = live.driver_state(whole)
    assert rows(feed.tables.state(), *want.columns) == rows(want)
    want = live.history(whole)
    assert rows(feed.tables.history(), *want.columns) == rows(want)
    want = live.alerts(whole)
    assert rows(feed.tables.alert_log(), *want.columns) == rows(want)
    want = live.race_pointer(whole)
    assert rows(feed.tables.race(), *want.columns) == rows(want)
    counts = feed.tables.metrics().agg(F.sum("rows"), F.sum("alerts")).first()
    assert tuple(counts) == (36, live.alerts(whole).count())


def test_alert_rules_and_reasons(spark):
    cases = [
        (event("A", 1, risk=0.75), 1, None),
        (event("A", 2, risk=0.75), 2, "HIGH risk for 2 consecutive clean laps"),
        (event("B", 1, high=False, risk=0.805), 0, "Risk score 0.81 >= fallback threshold 0.8"),
        (event("C", 1, high=False, risk=0.2, odd=True), 0,
         "ML anomaly (score=-0.4) without rule-based HIGH"),
        (event("D", 1, high=True, risk=0.75, odd=True), 1, None),
        (event("E", 1, high=False, clean=False, risk=0.9), 0, None),
        (event("F", 1, high=False, risk=None), 0, None),
    ]
    df = spark.createDataFrame([(*e, n) for e, n, _ in cases], EVENT + ", consecutive_high long")
    got = {(r.driver_code, r.lap): r.reason for r in live.alerts(df).collect()}
    assert got == {(e[3], e[4]): why for e, _, why in cases if why}


def test_history_keeps_changed_records_only_once(feed):
    feed.send([event("A", 1), event("A", 1), event("A", 1, time=91.0), event("A", None)])
    feed.drain()
    feed.send([event("A", 1)])
    feed.drain()
    got = rows(feed.tables.history(), "lap", "lap_time_sec", "order_key")
    assert got == [(1, 90.0, 1.0), (1, 91.0, 1.0), (None, 90.0, 0.0)]


def test_repeated_batch_changes_nothing(spark, feed):
    batch = spark.createDataFrame([(*event("A", n), n) for n in (1, 2)], EVENT + ", consecutive_high long")
    for _ in range(2):
        write_batch(batch, 0, feed.tables)
    assert feed.tables.alert_log().count() == 1
    assert feed.tables.history().count() == 2
    write_batch(batch.limit(0), 1, feed.tables)
    assert feed.tables.metrics().count() == 1


def test_merged_tables_read_the_same(spark, feed):
    """Folders grow with the logarithm of the batches, and every table reads as without merging."""
    whole = []
    for n in range(9):
        lap = [(*event(d, n + 1, odd=n % 3 == 0, high=False), 0) for d in ("A", f"B{n % 5}")]
        whole += lap
        write_batch(spark.createDataFrame(lap, EVENT + ", consecutive_high long"), n, feed.tables)
    df = spark.createDataFrame(whole, EVENT + ", consecutive_high long")
    for got, want in (
        (feed.tables.state(), live.driver_state(df)), (feed.tables.history(), live.history(df)),
        (feed.tables.alert_log(), live.alert_log(live.alerts(df))), (feed.tables.race(), live.race_pointer(df)),
    ):
        assert rows(got, *want.columns) == rows(want)
    assert sorted(r["batch_id"] for r in feed.tables.metrics().collect()) == list(range(9))
    version = feed.tables.log.newest()
    for table in ("state", "history", "alerts", "race", "metrics"):
        assert len(version.folders(table)) == 3  # 9 is 21 in base 4: two folders of 4 and one of 1
        assert len(feed.tables.log._names(table)) <= 3 + FAN + 1


def test_readers_see_one_version(spark, feed):
    def put(n):
        batch = spark.createDataFrame([(*event("A", n + 1), 1)], EVENT + ", consecutive_high long")
        write_batch(batch, n, feed.tables)

    put(0)
    seen = feed.tables.at()
    put(1)
    assert (seen.state().first().lap_number, seen.history().count()) == (1, 1)
    assert (feed.tables.state().first().lap_number, feed.tables.history().count()) == (2, 2)


def test_a_batch_that_failed_half_way_leaves_nothing(spark, feed, monkeypatch):
    batch = spark.createDataFrame([(*event("A", 1), 1)], EVENT + ", consecutive_high long")

    def broken(*_):
        raise OSError("no space")

    with monkeypatch.context() as m:
        m.setattr(live, "race_pointer", broken)
        with pytest.raises(OSError):
            write_batch(batch, 0, feed.tables)
    assert feed.tables.history() is None
    write_batch(batch, 0, feed.tables)
    assert feed.tables.history().count() == 1 and len(feed.tables.log._names("history")) == 1


def test_alerts_kept_are_bounded_per_race(spark, tmp_path):
    from dataclasses import replace

    from stintlab.config import RULES

    rules = replace(RULES, alert_log_size=3)
    tables = LiveTables(spark, str(tmp_path), rules=rules)
    for n in range(5):
        batch = spark.createDataFrame(
            [(*event(d, n + 1, risk=0.9), 5) for d in ("A", "B")], EVENT + ", consecutive_high long")
        write_batch(batch, n, tables, rules)
    assert [(r.lap, r.driver_code) for r in tables.alert_log().collect()] == [(5, "B"), (5, "A"), (4, "B")]
    stored = tables.log.read("alerts", tables.log.newest())
    assert stored.count() <= 3 * len(tables.log.newest().folders("alerts"))
    assert tables.metrics().agg(F.sum("alerts")).first()[0] == 10
    with pytest.raises(ValueError):
        tables.alert_log(4)


def test_shuffled_laps_over_many_batches_and_restarts(spark, feed, rng_laps):
    """Laps in any order over many small batches give the counters of the batch form."""
    events, order = rng_laps
    for part in order:
        feed.send([events[i] for i in part])
        feed.drain()  # each drain is a restart from the checkpoint
    whole = live.add_consecutive_high(spark.createDataFrame(events, EVENT))
    want = live.driver_state(whole)
    assert rows(feed.tables.state(), *want.columns) == rows(want)
    want = live.alerts(whole)
    assert rows(feed.tables.alert_log(), *want.columns) == rows(want)
    assert feed.tables.history().count() == len(events)


@pytest.fixture
def rng_laps():
    import random

    rng = random.Random(4)
    events = [
        event(d, lap, high=rng.random() < 0.7, clean=rng.random() < 0.9, odd=lap % 7 == 0)
        for d in ("A", "B", "C") for lap in range(1, 25)
    ]
    order = list(range(len(events)))
    rng.shuffle(order)
    return events, [order[i : i + 15] for i in range(0, len(order), 15)]


def test_a_gap_waits_for_the_watermark(feed):
    at = "2024-03-02T15:{:02d}:00+00:00".format
    feed.send([event("A", 1), event("A", 2)], at(0))
    feed.drain(lateness="10 minutes")
    feed.send([event("A", 4), event("A", 5)], at(1))
    feed.drain(lateness="10 minutes")
    assert feed.run_of("A") == (2, 2)  # lap 3 may still come
    feed.send([event("B", 1)], at(30))
    feed.drain(lateness="10 minutes")
    assert feed.run_of("A") == (5, 4)  # given up: the laps after it count on
    feed.send([event("A", 3, high=False)], at(31))
    feed.drain(lateness="10 minutes")
    assert feed.tables.history().filter("driver_code = 'A'").count() == 5  # late, but not lost


def test_a_heartbeat_lets_waiting_laps_go(feed):
    feed.send([event("A", 3), event("A", 4)])
    feed.drain()
    assert feed.tables.state() is None
    feed.beat("2024-03-02T16:00:00+00:00")
    feed.drain()
    assert feed.run_of("A") == (4, 2)


def test_idle_drivers_are_forgotten(feed):
    at = "2024-03-02T{:02d}:00:00+00:00".format
    feed.send([event("A", 1), event("A", 2)], at(10))
    feed.drain(idle="60000")
    feed.send([event("B", 1)], at(12))
    feed.drain(idle="60000")
    feed.send([event("A", 1)], at(12))
    feed.drain(idle="60000")
    assert [r.consecutive_high for r in feed.tables.state().filter("driver_code = 'A'").collect()] == [1]


def test_optional_duplicate_guard(feed):
    feed.send([event("A", 1), event("A", 2)])
    feed.drain(dedup_delay="10 minutes")
    feed.send([event("A", 2), event("A", 3)])
    feed.drain(dedup_delay="10 minutes")
    assert feed.run_of("A") == (3, 3)


def test_malformed_messages_do_not_stop_the_stream(spark, feed):
    bad = [("k", "not json"), ("k", '{"lap_number": 1}'), ("k", None)]
    df = spark.createDataFrame(bad, "key string, value string").withColumn("lap_number", F.lit(1))
    df.write.mode("append").parquet(f"{feed.root}/in")
    feed.send([event("A", 1)])
    feed.drain()
    assert feed.tables.metrics().agg(F.sum("rows")).first()[0] == 1


def test_readers_before_any_batch(feed):
    assert feed.tables.state() is None and feed.tables.alert_log() is None
    assert feed.tables.history() is None and feed.tables.race() is None


def test_state_text_round_trip(spark):
    df = spark.createDataFrame([(*event("A", 3), 2)], EVENT + ", consecutive_high long")
    text = live.state_text(live.driver_state(df))
    row = text.first()
    assert (row.stint, row.lap_time_sec, row.rainfall, row.consecutive_high) == ("", "90.000000", "False", "2")
    holes = text.withColumns({
        "risk_status": F.lit(None).cast("string"), "risk_score": F.lit("bad"), "lap_number": F.lit(""),
        "is_anomaly": F.lit("1"), "compound": F.lit(None).cast("string"),
    })
    back = live.read_state_text(holes).first()
    assert (back.risk_status, back.risk_score, back.lap_number) == ("INSUFFICIENT_DATA", 0.0, 0)
    assert back.is_anomaly is True and back.compound == "" and back.stint == 0
    assert back.lap_time_sec == 90.0


def test_alert_pages(spark):
    df = spark.range(1, 301).select(
        F.lit(2024).alias("year"), F.lit(1).alias("race_round"), F.col("id").alias("lap"),
        F.lit("A").alias("driver_code"), F.lit("r").alias("reason"),
    )
    assert [r.lap for r in live.alert_log(df).collect()] == list(range(300, 100, -1))
    assert live.recent_alerts(df).count() == 50


def test_kafka_transport_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        replay.kafka_source(spark, "nowhere:9092", "laps")
