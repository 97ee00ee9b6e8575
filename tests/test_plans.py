"""Physical plans keep the shape they were designed for."""

import pytest
from pyspark.sql import functions as F

from stintlab.config import SCALE, Scale
from stintlab.operators import live
from stintlab.operators.joins import lookup
from stintlab.plans import batch, catalog, lap_view
from stintlab.sources.tables import drop_staged, path_exists, stage, staged_dir


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, data, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "laps")
    lap_view.laps_of(lap_view.read(spark, data, "events")).write.parquet(path)
    return spark.read.parquet(path)


def test_all_stint_windows_share_one_shuffle(stored):
    text = plan(batch.stint_table(stored))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Window [") <= 3


def test_scored_events_shuffle_laps_once(stored):
    text = plan(batch.score_laps(stored).events)
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning(year" in line]
    assert sum("driver_code" in line for line in wide) == 1
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_state_needs_no_shuffle_after_the_run_window(stored):
    events = stored.withColumns(
        {c: F.lit(0.5) for c in (
            "pace_delta", "degradation_slope_5", "field_delta", "risk_score", "air_temp_c",
            "track_temp_c", "humidity", "wind_speed", "anomaly_score",
        )}
    ).withColumns(
        {"risk_status": F.lit("HIGH"), "clean_lap": F.lit(True), "rainfall": F.lit(False), "is_anomaly": F.lit(False)}
    )
    text = plan(live.driver_state(live.add_consecutive_high(events)))
    assert text.count("Exchange hashpartitioning") == 1


def _wide(text):
    """Shuffles of whole laps: those that carry the race's name along."""
    return [line for line in text.splitlines() if "Exchange hashpartitioning(" in line or "Exchange REPARTITION" in line]


def test_scores_runs_and_state_share_one_shuffle_of_laps(stored):
    """Stint windows, the run counter and the live state find a driver's laps where the first shuffle put them."""
    scored = batch.score_laps(stored).events
    for c in ("air_temp_c", "track_temp_c", "humidity", "wind_speed", "anomaly_score"):
        scored = scored.withColumn(c, F.lit(0.5)) if c not in scored.columns else scored
    scored = scored.withColumns({c: F.lit(False) for c in ("rainfall", "is_anomaly") if c not in scored.columns})
    counted = live.add_consecutive_high(scored, counted=stored)
    for df in (scored, counted, live.driver_state(counted)):
        by_driver = [line for line in _wide(plan(df)) if "driver_code" in line]
        assert len(by_driver) == 1


def test_only_needed_columns_are_read(spark, data):
    text = plan(catalog.QUERIES["corpus_summary"](spark, data))
    assert "props" not in text and "value#" not in text
    text = plan(catalog.QUERIES["laps_by_driver"](spark, data))
    assert "ReadSchema: struct<user_id:bigint>" in text


def test_lookup_is_broadcast_by_size_only(spark, stored):
    table = stored.groupBy("driver_code").agg(F.count("*").alias("n"))
    assert "BroadcastHashJoin" in plan(lookup(stored, table, ["driver_code"], scale=SCALE))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        beyond = Scale(broadcast_rows=3)
        text = plan(lookup(stored, table, ["driver_code"], scale=beyond))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_wide_rows_that_compress_well_are_not_broadcast(spark, stored):
    """Few bytes on disk are no measure: 400-byte values count in full."""
    wide = spark.range(2000).select(
        F.concat(F.lit("D"), F.col("id")).alias("driver_code"), F.repeat(F.lit("x"), 400).alias("note")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(lookup(stored, wide, ["driver_code"], scale=Scale(broadcast_bytes=400_000)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_staged_tables_live_in_the_shared_folder(spark, stored):
    kept = stage(stored.limit(3))
    assert staged_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert kept.count() == 3
    drop_staged(spark)
    assert not path_exists(spark, staged_dir(spark))


def test_a_scope_removes_what_was_staged_in_it(spark):
    from stintlab.sources.tables import matching_paths, staging

    kept = stage(spark.range(3))
    with staging(spark):
        inner = stage(spark.range(5))
        with staging(spark):
            stage(spark.range(7))
        assert inner.count() == 5 and len(matching_paths(spark, f"{staged_dir(spark)}/scope-*/*")) == 1
    assert kept.count() == 3 and not path_exists(spark, f"{staged_dir(spark)}/scope-*")


def test_session_has_the_settings_the_operators_count_on(spark):
    from stintlab.session import _SETTINGS, get_spark
    from stintlab.streaming.lap_order import STATE_SETTINGS

    assert get_spark("tests") is spark
    assert {k: spark.conf.get(k) for k in _SETTINGS} == _SETTINGS
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    name = "spark.sql.streaming.stateStore.providerClass"
    assert _SETTINGS[name] == STATE_SETTINGS[name]
