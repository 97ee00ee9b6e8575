"""Every operator as a named query over the given tables.

All start from the events table through the lap view and read it whole.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlab.functions import columns as C
from stintlab.operators import baselines as B
from stintlab.operators import forest as M
from stintlab.operators import laps as L
from stintlab.operators import live, reports
from stintlab.operators.slopes import add_degradation_slopes
from stintlab.operators.weather import attach_weather
from stintlab.plans import lap_view, serving
from stintlab.plans.batch import Layout, score_laps, write_events, write_features
from stintlab.schemas import BASELINE_KEYS, FIELD_KEYS, LAP_DDL, STINT_KEYS, names_of
from stintlab.sources import laps as store
from stintlab.sources import replay
from stintlab.sources.tables import fingerprint, free_shuffles, shared_dir, stage
from stintlab.streaming.monitor import LiveTables, start_monitor

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LAP_KEY = [*STINT_KEYS, "lap_number"]
EVENT_TIME = "2024-01-01T00:00:00+00:00"
# Past the lateness of the monitor: laps behind a gap go too.
RACE_OVER = "2024-01-02T00:00:00+00:00"
DRIVER = "D7"
RACE = "Race 1"


def query(fn: Query) -> Query:
    """Register a query; its doubles are rounded to 6 digits for comparison."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = fn(spark, sf_dir)
        doubles = [f.name for f in out.schema if f.dataType.typeName() == "double"]
        # Ties, and what floating noise makes of them, go up.
        return out.withColumns({c: F.expr(f"floor(`{c}` * 1e6D + 0.5001D) / 1e6D") for c in doubles})

    QUERIES[fn.__name__] = run
    return fn


# --- shared inputs --------------------------------------------------------------------------


def laps(spark: SparkSession, d: str) -> DataFrame:
    return lap_view.laps_of(lap_view.read(spark, d, "events"))


def weather(spark: SparkSession, d: str) -> DataFrame:
    return lap_view.weather_of(lap_view.read(spark, d, "events"))


def weather_laps(spark: SparkSession, d: str) -> DataFrame:
    return attach_weather(laps(spark, d), weather(spark, d))


def features(spark: SparkSession, d: str) -> DataFrame:
    """Lap features without weather, for queries that need none."""
    return L.build_lap_features(laps(spark, d))


def weather_features(spark: SparkSession, d: str) -> DataFrame:
    """Weather depends on the lap start alone, so it joins last: shuffled rows stay narrow."""
    return attach_weather(features(spark, d), weather(spark, d))


def flagged(spark: SparkSession, d: str) -> DataFrame:
    return L.add_tyre_age_bucket(L.add_clean_lap(laps(spark, d)))


def sloped(spark: SparkSession, d: str) -> DataFrame:
    return add_degradation_slopes(L.add_stint_windows(flagged(spark, d)))


# A fixed small forest over three inputs, as (tree, node, feature, split, path). Fixed values.
HAND_FOREST = [
    (0, 0, 0, 0.5, 0.0), (0, 1, 1, 12.0, 0.0), (0, 2, -1, 0.0, 1.5), (0, 3, -1, 0.0, 3.0),
    (0, 4, -1, 0.0, 2.5),
    (1, 0, 2, 0.5, 0.0), (1, 1, -1, 0.0, 2.0), (1, 2, 0, -1.0, 0.0), (1, 5, -1, 0.0, 2.25),
    (1, 6, -1, 0.0, 3.5),
    (2, 0, 1, 20.0, 0.0), (2, 1, 0, 3.0, 0.0), (2, 2, -1, 0.0, 1.0), (2, 3, -1, 0.0, 4.0),
    (2, 4, -1, 0.0, 2.0),
]
HAND_INPUTS = ["pace_delta", "tyre_life", "field_delta"]


def hand_forest(spark: SparkSession) -> M.Forest:
    nodes = spark.createDataFrame(HAND_FOREST, M.NODE_DDL)
    return M.Forest(nodes, HAND_INPUTS, 8, 3, 0.05, 8, -0.6)


def events(spark: SparkSession, d: str) -> DataFrame:
    """Events without weather, with risk and the small forest's anomaly scores."""
    return M.score_events(score_laps(laps(spark, d)).events, hand_forest(spark))


def weather_events(spark: SparkSession, d: str) -> DataFrame:
    return attach_weather(events(spark, d), weather(spark, d))


def counted(spark: SparkSession, d: str) -> DataFrame:
    return live.add_consecutive_high(weather_events(spark, d), counted=laps(spark, d))


# --- ingestion ------------------------------------------------------------------------------


@query
def normalize_laps(spark, d):
    v = laps(spark, d)

    def interval(name: str) -> Column:
        zero = F.lit(0)
        return F.when(
            F.col(name).isNotNull(),
            F.make_dt_interval(zero, zero, zero, F.col(name).cast("decimal(18,6)")),
        )

    raw = v.select(
        "year", "race_round", "race_name", "session_name",
        F.col("driver_code").alias("Driver"),
        F.col("driver_number").alias("DriverNumber"),
        F.col("team").alias("Team"),
        F.col("lap_number").cast("double").alias("LapNumber"),
        interval("lap_time_sec").alias("LapTime"),
        interval("sector1_sec").alias("Sector1Time"),
        interval("sector2_sec").alias("Sector2Time"),
        interval("sector3_sec").alias("Sector3Time"),
        F.col("compound").alias("Compound"),
        F.col("tyre_life").cast("string").alias("TyreLife"),
        F.when(F.col("event_id") % 43 == 0, "?")
        .otherwise(F.col("stint").cast("string"))
        .alias("Stint"),
        interval("pit_in_time").alias("PitInTime"),
        interval("pit_out_time").alias("PitOutTime"),
        F.col("track_status").alias("TrackStatus"),
        F.col("is_accurate").alias("IsAccurate"),
        interval("lap_start_time_sec").alias("LapStartTime"),
    )
    return L.normalize_laps(raw, *[F.col(c) for c in raw.columns[:4]])


@query
def constructor_key(spark, d):
    padded = F.concat(F.lit(" \t"), F.col("team"), F.lit("-A/B \n"))
    return (
        laps(spark, d)
        .groupBy("team")
        .agg(F.count("*").alias("laps"))
        .withColumns({"plain": C.slug(F.col("team")), "padded": C.slug(padded)})
    )


@query
def ingest_skip_existing(spark, d):
    v = laps(spark, d)
    stored = v.filter(F.col("race_round") % 2 == 0).select("year", "race_round").distinct()
    return store.only_new(v, stored).select(*LAP_KEY)


def _schedule(spark, d) -> DataFrame:
    v = laps(spark, d)
    return v.select("year", (F.col("race_round") - 1).alias("round"), "race_name").distinct()


@query
def race_rounds(spark, d):
    return store.race_rounds(_schedule(spark, d))


def _manifest(spark, d) -> DataFrame:
    v = laps(spark, d)
    return store.sweep_manifest(
        _schedule(spark, d),
        v.filter(F.col("race_round") % 3 != 0),
        v.filter(F.col("race_round") % 2 == 0),
    )


@query
def sweep_manifest(spark, d):
    return _manifest(spark, d)


@query
def sweep_counts(spark, d):
    return _manifest(spark, d).groupBy("status").agg(F.count("*").alias("races"))


@query
def corpus_by_year(spark, d):
    return store.corpus_by_year(laps(spark, d))


@query
def asof_weather(spark, d):
    return weather_laps(spark, d).select(
        *LAP_KEY, "lap_start_time_sec", "air_temp_c", "track_temp_c", "humidity", "pressure",
        "rainfall", "wind_speed", "wind_direction",
    )


@query
def ingest_profile(spark, d):
    return reports.ingest_profile(weather_laps(spark, d))


@query
def ingest_compounds(spark, d):
    return reports.distinct_values(laps(spark, d), "compound")


@query
def ingest_drivers(spark, d):
    return reports.distinct_values(laps(spark, d), "driver_code")


# --- lap features ---------------------------------------------------------------------------


@query
def clean_lap(spark, d):
    return flagged(spark, d).select(*LAP_KEY, "clean_lap")


@query
def tyre_age_bucket(spark, d):
    return flagged(spark, d).select(*LAP_KEY, "tyre_life", "tyre_age_bucket")


@query
def stint_counters(spark, d):
    return L.add_stint_counters(flagged(spark, d)).select(
        *LAP_KEY, "stint_lap_number", "clean_laps_in_stint_so_far"
    )


@query
def rolling_pace(spark, d):
    return L.add_stint_windows(flagged(spark, d)).select(
        *LAP_KEY, "rolling_3_lap_avg", "rolling_5_lap_avg", "previous_5_lap_avg", "pace_delta"
    )


@query
def field_median(spark, d):
    return L.add_field_median(flagged(spark, d)).select(
        *LAP_KEY, "field_median_lap_time", "field_delta"
    )


FEATURE_COLUMNS = [
    *names_of(LAP_DDL), "air_temp_c", "track_temp_c", "humidity", "pressure", "rainfall",
    "wind_speed", "wind_direction", "clean_lap", "stint_lap_number", "clean_laps_in_stint_so_far",
    "tyre_age_bucket", "rolling_3_lap_avg", "rolling_5_lap_avg", "previous_5_lap_avg",
    "pace_delta", "field_median_lap_time", "field_delta",
]


@query
def lap_features(spark, d):
    return weather_features(spark, d).select(*FEATURE_COLUMNS)


@query
def lap_quality_report(spark, d):
    return reports.lap_quality(flagged(spark, d))


@query
def laps_by_compound(spark, d):
    return reports.laps_by_compound(laps(spark, d))


@query
def laps_by_driver(spark, d):
    return reports.laps_by_driver(laps(spark, d))


@query
def short_stints(spark, d):
    return reports.short_stints(flagged(spark, d))


# --- slopes, baselines, risk ----------------------------------------------------------------


@query
def degradation_slopes(spark, d):
    return sloped(spark, d).select(*LAP_KEY, "degradation_slope_3", "degradation_slope_5")


@query
def compound_age_baselines(spark, d):
    return B.compound_age_baselines(sloped(spark, d))


@query
def field_baselines(spark, d):
    return B.add_field_baselines(sloped(spark, d)).select(
        *LAP_KEY, "field_median_degradation_slope", "field_median_pace_delta",
        "field_std_degradation_slope", "field_std_pace_delta", "driver_vs_field_delta",
    )


@query
def field_statistics(spark, d):
    _, field = B.lap_statistics(sloped(spark, d))
    return field.select(*FIELD_KEYS, "field_median_lap_time", "field_std_pace_delta")


@query
def baseline_rollups(spark, d):
    base, _ = B.lap_statistics(sloped(spark, d))
    out = None
    for tier, keys in zip(("race_compound", "compound_age", "global"), B.TIERS[1:]):
        named = B.rollup(base, keys).withColumn("tier", F.lit(tier))
        named = named if keys else named.drop("sample_count")
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    return out.select("tier", *BASELINE_KEYS, *B.CHOSEN, "sample_count")


@query
def attach_baselines(spark, d):
    return score_laps(laps(spark, d)).events.select(
        *LAP_KEY, *B.CHOSEN.values(), "compound_baseline_delta", "compound_baseline_slope"
    )


@query
def risk_score(spark, d):
    return events(spark, d).select(
        *LAP_KEY, "pace_component", "slope_component", "field_component", "risk_score",
        "risk_status",
    )


@query
def risk_distribution(spark, d):
    return reports.risk_distribution(events(spark, d))


@query
def slope_sample(spark, d):
    return reports.slope_sample(events(spark, d))


@query
def replay_events(spark, d):
    return weather_events(spark, d).select(*replay.PAYLOAD_FIELDS)


# --- anomaly model --------------------------------------------------------------------------


@query
def anomaly_training_frame(spark, d):
    return M.training_frame(weather_features(spark, d)).select(*LAP_KEY, *M.ANOMALY_FEATURES)


@query
def forest_scores(spark, d):
    return M.score_events(features(spark, d), hand_forest(spark)).select(
        *LAP_KEY, "anomaly_score", "is_anomaly"
    )


@query
def anomaly_no_model(spark, d):
    return M.score_events(flagged(spark, d), None).select(*LAP_KEY, "anomaly_score", "is_anomaly")


def _trained(spark, d) -> DataFrame:
    # Training reads its input several times, so it gets a written table of the columns it needs.
    table = stage(
        weather_features(spark, d).select(*LAP_KEY, "compound", "clean_lap", *M.ANOMALY_FEATURES)
    )
    return M.score_events(table, M.fit_forest(M.training_frame(table)))


@query
def isolation_forest(spark, d):
    return _trained(spark, d).select(*LAP_KEY, "clean_lap", "anomaly_score", "is_anomaly")


@query
def isolation_forest_report(spark, d):
    return reports.anomaly_report(_trained(spark, d).filter("clean_lap"))


@query
def anomaly_report(spark, d):
    return reports.anomaly_report(events(spark, d))


@query
def anomaly_by_compound(spark, d):
    return reports.anomaly_by_compound(events(spark, d))


@query
def top_anomalies(spark, d):
    return reports.top_anomalies(events(spark, d))


# --- replay ---------------------------------------------------------------------------------


@query
def replay_filter(spark, d):
    return replay.filter_race(laps(spark, d), f"2024 {RACE}").select(*LAP_KEY)


@query
def replay_filter_by_name(spark, d):
    return replay.filter_race(laps(spark, d), RACE).select(*LAP_KEY)


@query
def replay_messages(spark, d):
    of_lap = F.concat(
        F.lit("2024-01-01T00:"), F.lpad(F.col("lap_number") % 60, 2, "0"), F.lit(":00+00:00")
    )
    sent = replay.in_replay_order(
        replay.replay_messages(weather_events(spark, d), event_time=of_lap)
    )
    event = F.from_json("value", replay.struct_of(replay.EVENT_DDL)).alias("e")
    return sent.select("key", event).select("key", "e.*")


@query
def replay_until_lap(spark, d):
    return replay.replay_messages(laps(spark, d), max_laps=20, event_time=EVENT_TIME).select(
        "key", "lap_number"
    )


@query
def parse_events(spark, d):
    e = events(spark, d)
    sent = replay.replay_messages(
        e.withColumn("driver_number", F.col("event_id").cast("string")), event_time=EVENT_TIME
    )
    case = F.get_json_object("value", "$.driver_number").cast("bigint") % 10
    damaged = (
        F.when(case == 0, F.concat(F.lit("not json "), F.col("value")))
        .when(case == 1, F.regexp_replace("value", '"driver_code":"[^"]*"', '"driver_code":""'))
        .when(case == 2, F.regexp_replace("value", '"stint":([0-9]+)', '"stint":"$1 or so"'))
        .otherwise(F.col("value"))
    )
    return replay.parse_messages(sent.withColumn("value", damaged)).select(
        "driver_number", "driver_code", "stint", "lap_number", "risk_score", "risk_status",
        "clean_lap", "event_time",
    )


@query
def replay_summary(spark, d):
    return reports.replay_summary(laps(spark, d))


@query
def replay_groups(spark, d):
    return reports.replay_groups(laps(spark, d))


# --- live view ------------------------------------------------------------------------------


@query
def consecutive_high(spark, d):
    return live.add_consecutive_high(events(spark, d), counted=laps(spark, d)).select(
        *LAP_KEY, "risk_status", "clean_lap", "consecutive_high"
    )


def _alerts(spark, d) -> DataFrame:
    return live.alerts(live.add_consecutive_high(events(spark, d), counted=laps(spark, d)))


def shown(alert_rows: DataFrame) -> DataFrame:
    """Reasons with their score to 6 digits, as all doubles are compared."""
    score = F.regexp_extract("reason", r"\(score=([^)]*)\)", 1).try_cast("double")
    short = F.format_string("ML anomaly (score=%.6f) without rule-based HIGH", score)
    return alert_rows.withColumn("reason", F.when(score.isNotNull(), short).otherwise(F.col("reason")))


@query
def alerts(spark, d):
    return shown(_alerts(spark, d))


@query
def alerts_log(spark, d):
    return shown(live.alert_log(_alerts(spark, d)))


@query
def recent_alerts(spark, d):
    return shown(live.recent_alerts(_alerts(spark, d))).select(*live.ALERT_COLUMNS)


@query
def driver_state(spark, d):
    return live.driver_state(counted(spark, d))


@query
def state_text(spark, d):
    return live.state_text(live.driver_state(counted(spark, d)))


@query
def driver_board(spark, d):
    return live.driver_board(live.state_text(live.driver_state(counted(spark, d))))


@query
def live_header(spark, d):
    return live.live_header(live.driver_state(counted(spark, d)))


@query
def driver_history(spark, d):
    return live.history(events(spark, d))


@query
def driver_trend(spark, d):
    return live.driver_trend(live.history(events(spark, d)), DRIVER)


@query
def race_current(spark, d):
    return live.race_pointer(laps(spark, d))


# Tables that a job or a stream has written, kept per session and input so that each is written once.
_written: dict[tuple, object] = {}


def _once(kind: str, spark: SparkSession, d: str, make: Callable[[str], object]):
    key = (kind, spark.sparkContext.applicationId, d, fingerprint(spark, f"{d}/events.parquet"))
    if key not in _written:
        _written[key] = make(f"{shared_dir(spark)}/{kind}/{uuid.uuid4().hex}")
    return _written[key]


UPDATED = "2024-01-01 00:00:00"


def _monitored(spark, d) -> LiveTables:
    """The monitor's tables after a drained stream of all messages."""

    def make(root: str) -> LiveTables:
        replay.publish_race_files(weather_events(spark, d), f"{root}/messages", EVENT_TIME, RACE_OVER)
        tables = LiveTables(spark, f"{root}/tables")
        source = replay.file_source(spark, f"{root}/messages", bytes_per_batch=1 << 30)
        now = F.lit(UPDATED).cast("timestamp")
        start_monitor(source, tables, f"{root}/checkpoint", drain=True, now=now).awaitTermination()
        return tables

    return _once("live", spark, d, make)


@query
def stream_history(spark, d):
    """The monitor run over all messages as a drained stream; its history table."""
    return _monitored(spark, d).history()


@query
def stream_state(spark, d):
    return live.state_text(_monitored(spark, d).state())


@query
def stream_alerts(spark, d):
    log = _monitored(spark, d).alert_log().drop("batch_id")
    return shown(log).withColumn("timestamp", F.col("timestamp").cast("string"))


@query
def stream_header(spark, d):
    tables = _monitored(spark, d)
    header = live.with_race(live.live_header(tables.state()), tables.race())
    return header.withColumn("updated_at", F.col("updated_at").cast("string"))


def _monitored_shuffled(spark, d) -> LiveTables:
    """The same with laps in any order over several micro-batches, and a restart before the last of them."""

    # Three batches, each of as many files as keep the tasks busy that write and read them.
    per_batch = 2 * math.ceil(spark.sparkContext.defaultParallelism / 6)

    def publish(path: str) -> None:
        # Laid out before they become text, which is twice as large.
        laid = weather_events(spark, d).repartition(3 * per_batch, F.xxhash64("driver_code", "lap_number"))
        sent = replay.replay_messages(laid, event_time=EVENT_TIME)
        sent.write.option("compression", "zstd").parquet(path)

    def make(root: str) -> LiveTables:
        publish(f"{root}/messages")
        free_shuffles(spark)
        tables, now = LiveTables(spark, f"{root}/tables"), F.lit(UPDATED).cast("timestamp")
        for last in (False, True):
            if last:
                replay.heartbeat(spark, RACE_OVER).coalesce(1).write.mode("append").parquet(f"{root}/messages")
            source = replay.file_source(spark, f"{root}/messages", files_per_batch=per_batch)
            start_monitor(source, tables, f"{root}/checkpoint", drain=True, now=now).awaitTermination()
        return tables

    return _once("shuffled", spark, d, make)


@query
def stream_shuffled_state(spark, d):
    return live.state_text(_monitored_shuffled(spark, d).state())


@query
def stream_shuffled_history(spark, d):
    return _monitored_shuffled(spark, d).history()


@query
def stream_race(spark, d):
    return _monitored(spark, d).race().select("race_name", "year", "last_lap", F.col("updated_at").cast("string"))


@query
def stream_metrics(spark, d):
    return _monitored(spark, d).metrics().agg(F.sum("rows").alias("rows"), F.sum("alerts").alias("alerts"))


# --- written tables read back ---------------------------------------------------------------


# Each step writes its tables after those it reads, so a query waits for what it needs and no more.


def _layout(spark, d) -> Layout:
    return _once("stored", spark, d, Layout.under)


def _step(name: str, spark, d, write: Callable[[Layout], object]) -> Layout:
    at = _layout(spark, d)

    def make(_: str) -> Layout:
        write(at)
        return at

    return _once(f"stored-{name}", spark, d, make)


def _stored_raw(spark, d) -> Layout:
    return _step("raw", spark, d, lambda at: store.write_raw_laps(weather_laps(spark, d).drop("event_id"), at.raw))


def _stored_features(spark, d) -> Layout:
    _stored_raw(spark, d)
    return _step("features", spark, d, lambda at: write_features(spark, at))


def _stored_model(spark, d) -> Layout:
    return _step("model", spark, d, lambda at: hand_forest(spark).save(at.model))


def _stored(spark, d) -> Layout:
    """Raw laps, features, a saved forest, baselines and events, each written by its own step."""
    _stored_features(spark, d)
    _stored_model(spark, d)
    return _step("events", spark, d, lambda at: write_events(spark, at))


@query
def stored_raw_laps(spark, d):
    return store.read_raw_laps(spark, _stored_raw(spark, d).raw).select(*names_of(LAP_DDL), "round")


@query
def stored_races(spark, d):
    return store.existing_races(spark, _stored_raw(spark, d).raw)


@query
def stored_inventory(spark, d):
    """Races and rows per season of what was written, from file footers."""
    return store.stored_by_year(spark, _stored_raw(spark, d).raw)


@query
def stored_baselines(spark, d):
    return spark.read.parquet(_stored(spark, d).baselines)


@query
def stored_events(spark, d):
    return spark.read.parquet(_stored(spark, d).events).select(*replay.PAYLOAD_FIELDS)


@query
def saved_forest_scores(spark, d):
    forest = M.load_forest(spark, _stored_model(spark, d).model)
    return M.score_events(features(spark, d), forest).select(*LAP_KEY, "anomaly_score", "is_anomaly")


def _report(name: str) -> None:
    def report(spark, d):
        view, _ = serving.REPORTS[name]
        stored = _stored_features if view == "lap_features" else _stored
        serving.register_views(spark, stored(spark, d).views(), [view])
        return serving.run_report(spark, name)

    report.__name__ = f"report_{name}"
    query(report)


for _name in serving.REPORTS:
    _report(_name)


# --- reports for users ----------------------------------------------------------------------


@query
def corpus_summary(spark, d):
    return reports.corpus_summary(laps(spark, d))


@query
def driver_pace(spark, d):
    return reports.driver_pace(L.add_stint_windows(flagged(spark, d)))


@query
def compound_temp(spark, d):
    table = L.add_stint_windows(L.add_clean_lap(laps(spark, d)))
    return reports.compound_temp(attach_weather(table, weather(spark, d)))


@query
def stint_lengths(spark, d):
    return reports.stint_lengths(laps(spark, d))


@query
def risk_by_compound(spark, d):
    return reports.risk_by_compound(events(spark, d))


@query
def wet_dry(spark, d):
    return reports.wet_dry(L.add_clean_lap(weather_laps(spark, d)))


@query
def clean_by_compound(spark, d):
    return reports.clean_by_compound(flagged(spark, d))


@query
def free_sql(spark, d):
    L.build_lap_features(laps(spark, d)).createOrReplaceTempView("lap_features")
    return serving.read_only_sql(spark, serving.DEFAULT_SQL)
