"""Lap-level features: normalising, clean flag, stint counters, rolling pace, field median."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlab.config import RULES, SCALE, Rules, Scale
from stintlab.functions import columns as C
from stintlab.operators.joins import lookup
from stintlab.operators.ordered import (
    Frames,
    blocked_framed,
    blocked_running,
    framed,
    per_stint,
    spread_rank,
)
from stintlab.operators.quantiles import group_medians
from stintlab.schemas import FIELD_KEYS, LAP_ORDER, RAW_COLUMNS, STINT_KEYS, require


def normalize_laps(
    raw: DataFrame,
    year: Column,
    race_round: Column,
    race_name: Column,
    session_name: Column,
) -> DataFrame:
    """Raw session rows to the 21-column lap table.

    The session columns are expressions, so one call covers any number of sessions: literals for
    a single one, columns of raw for many.
    """
    require(raw, RAW_COLUMNS, "raw laps")

    def secs(name: str) -> Column:
        return C.seconds(F.col(name), raw.schema[name].dataType)

    return raw.select(
        year.cast("int").alias("year"),
        race_round.cast("int").alias("race_round"),
        race_name.cast("string").alias("race_name"),
        session_name.cast("string").alias("session_name"),
        F.col("Driver").cast("string").alias("driver_code"),
        F.col("DriverNumber").cast("string").alias("driver_number"),
        F.col("Team").cast("string").alias("team"),
        C.slug(F.col("Team").cast("string")).alias("constructor_key"),
        C.number(F.col("LapNumber"), "bigint").alias("lap_number"),
        secs("LapTime").alias("lap_time_sec"),
        secs("Sector1Time").alias("sector1_sec"),
        secs("Sector2Time").alias("sector2_sec"),
        secs("Sector3Time").alias("sector3_sec"),
        F.col("Compound").cast("string").alias("compound"),
        C.number(F.col("TyreLife"), "double").alias("tyre_life"),
        C.number(F.col("Stint"), "bigint").alias("stint"),
        secs("PitInTime").alias("pit_in_time"),
        secs("PitOutTime").alias("pit_out_time"),
        F.col("TrackStatus").cast("string").alias("track_status"),
        F.col("IsAccurate").try_cast("boolean").alias("is_accurate"),
        secs("LapStartTime").alias("lap_start_time_sec"),
    )


def add_clean_lap(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    return df.withColumn("clean_lap", C.is_clean_lap(rules))


def add_tyre_age_bucket(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    return df.withColumn("tyre_age_bucket", C.tyre_age_bucket(F.col("tyre_life"), rules))


def _clean_count() -> Column:
    return F.col("clean_lap").cast("int")


def _count_plain(df: DataFrame) -> DataFrame:
    w = Window.partitionBy(*STINT_KEYS).orderBy(*LAP_ORDER)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns(
        {
            "stint_lap_number": F.row_number().over(w).cast("bigint"),
            "clean_laps_in_stint_so_far": F.sum(_clean_count()).over(so_far),
        }
    )


def _count_blocked(df: DataFrame, scale: Scale) -> DataFrame:
    numbered = spread_rank(df, STINT_KEYS, LAP_ORDER, "stint_lap_number", scale)
    clean = {"clean_laps_in_stint_so_far": ("sum", _clean_count())}
    return blocked_running(numbered, STINT_KEYS, "stint_lap_number", clean, scale)


def _pace_frames() -> Frames:
    clean_time = C.clean_only("lap_time_sec")
    return {
        "rolling_3_lap_avg": (F.avg(clean_time), -2, 0),
        "rolling_5_lap_avg": (F.avg(clean_time), -4, 0),
        "previous_5_lap_avg": (F.avg(clean_time), -5, -1),
    }


def _pace_delta(df: DataFrame) -> DataFrame:
    return df.withColumn("pace_delta", F.col("lap_time_sec") - F.col("previous_5_lap_avg"))


def _pace_plain(df: DataFrame) -> DataFrame:
    return _pace_delta(framed(df, STINT_KEYS, LAP_ORDER, _pace_frames()))


def _pace_blocked(df: DataFrame, scale: Scale) -> DataFrame:
    return _pace_delta(blocked_framed(df, STINT_KEYS, "stint_lap_number", _pace_frames(), scale))


def stint_windows_plain(df: DataFrame) -> DataFrame:
    return _pace_plain(_count_plain(df))


def stint_windows_blocked(df: DataFrame, scale: Scale) -> DataFrame:
    return _pace_blocked(_count_blocked(df, scale), scale)


def add_stint_counters(df: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """Position of each lap in its stint, and clean laps in the stint up to it."""
    return per_stint(df, _count_plain, lambda hot: _count_blocked(hot, scale), scale)


def add_rolling_pace(df: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """Clean-lap averages over the last 3 and 5 laps and over the 5 before this one."""
    return per_stint(df, _pace_plain, lambda hot: _pace_blocked(hot, scale), scale)


def add_stint_windows(df: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """Counters and rolling pace together: one shuffle on the stint, oversized stints split once."""
    return per_stint(
        df, stint_windows_plain, lambda hot: stint_windows_blocked(hot, scale), scale
    )


def field_medians(df: DataFrame) -> DataFrame:
    """Median clean lap time of the field on each race lap, exact for a field of any size."""
    times = df.select(*FIELD_KEYS, C.clean_only("lap_time_sec").alias("clean_time"))
    found = group_medians(times, [FIELD_KEYS], {"field_median_lap_time": "clean_time"}, [])
    return found.select(*FIELD_KEYS, "field_median_lap_time")


def add_field_median(df: DataFrame, scale: Scale = SCALE) -> DataFrame:
    out = lookup(df, field_medians(df), FIELD_KEYS, scale=scale)
    return out.withColumn("field_delta", F.col("lap_time_sec") - F.col("field_median_lap_time"))


def build_lap_features(laps: DataFrame, rules: Rules = RULES, scale: Scale = SCALE) -> DataFrame:
    """Lap table (with or without weather) to lap features.

    The field median needs no window, so it is taken from the flagged laps directly and its
    branch reads six columns.
    """
    flagged = add_tyre_age_bucket(add_clean_lap(laps, rules), rules)
    out = lookup(add_stint_windows(flagged, scale), field_medians(flagged), FIELD_KEYS, scale=scale)
    return out.withColumn("field_delta", F.col("lap_time_sec") - F.col("field_median_lap_time"))
