"""Per-driver live view as batch operators: runs of HIGH, alerts, state, history, race pointer.

Everything is keyed on (year, race_round, driver_code), so races never mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlab.config import RULES, SCALE, Rules, Scale
from stintlab.operators.ordered import blocked_running, per_group, spread_rank
from stintlab.schemas import LAP_ORDER, LIVE_KEYS

# Fields of the live state of one driver, in store order; the value is the event field.
STATE_FIELDS = {
    "driver_code": "driver_code",
    "constructor_key": "constructor_key",
    "race_name": "race_name",
    "lap_number": "lap_number",
    "compound": "compound",
    "tyre_life": "tyre_life",
    "stint": "stint",
    "lap_time_sec": "lap_time_sec",
    "pace_delta": "pace_delta",
    "degradation_slope": "degradation_slope_5",
    "field_delta": "field_delta",
    "risk_score": "risk_score",
    "risk_status": "risk_status",
    "air_temp_c": "air_temp_c",
    "track_temp_c": "track_temp_c",
    "humidity": "humidity",
    "rainfall": "rainfall",
    "wind_speed": "wind_speed",
    "anomaly_score": "anomaly_score",
    "is_anomaly": "is_anomaly",
    "consecutive_high": "consecutive_high",
}

# Fixed values.
HISTORY_FIELDS = [
    "lap_time_sec", "risk_score", "pace_delta", "tyre_life", "compound", "risk_status",
]

# Fixed values.
ALERT_COLUMNS = ["lap", "driver_code", "compound", "tyre_life", "risk_score", "reason"]


def _is_up() -> Column:
    return F.coalesce((F.col("risk_status") == "HIGH") & F.col("clean_lap"), F.lit(False))


def _last_break() -> Column:
    """Position of a row that ends a run."""
    return F.when(~_is_up(), F.col("_lap_rank"))


def _run_length() -> Column:
    since = F.col("_lap_rank") - F.coalesce(F.col("_break"), F.lit(0))
    return F.when(_is_up(), since).otherwise(F.lit(0)).cast("bigint")


def _runs_plain(df: DataFrame) -> DataFrame:
    w = Window.partitionBy(*LIVE_KEYS).orderBy(*LAP_ORDER)
    out = df.withColumn("_lap_rank", F.row_number().over(w).cast("bigint"))
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn("_break", F.max(_last_break()).over(so_far))


def _runs_blocked(df: DataFrame, scale: Scale) -> DataFrame:
    out = spread_rank(df, LIVE_KEYS, LAP_ORDER, "_lap_rank", scale)
    return blocked_running(
        out, LIVE_KEYS, "_lap_rank", {"_break": ("max", _last_break())}, scale
    )


def add_consecutive_high(
    df: DataFrame, scale: Scale = SCALE, counted: DataFrame | None = None
) -> DataFrame:
    """Length of the run of clean HIGH laps ending at each lap; 0 elsewhere.

    It is the distance to the last lap that was not one. counted may name the laps that df was
    derived from, to look for oversized groups there.
    """
    out = per_group(
        df,
        LIVE_KEYS,
        _runs_plain,
        lambda hot: _runs_blocked(hot, scale),
        scale,
        counted=counted,
    )
    return out.withColumn("consecutive_high", _run_length()).drop("_lap_rank", "_break")


def alerts(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Alert rows of clean laps, with the first matching reason; df has consecutive_high.

    The score rule looks at the score alone, so a lap short of data can alert too.
    """
    risk = F.coalesce(F.col("risk_score"), F.lit(0.0))
    high = F.coalesce(F.col("risk_status") == "HIGH", F.lit(False))
    by_run = high & (F.col("consecutive_high") >= rules.alert_run_length)
    by_risk = risk >= rules.alert_risk
    by_model = F.coalesce(F.col("is_anomaly"), F.lit(False)) & ~high
    score = F.coalesce(F.col("anomaly_score").cast("string"), F.lit("None"))
    # Fixed formats of the three reasons.
    reason = (
        F.when(
            by_run,
            F.format_string("HIGH risk for %d consecutive clean laps", F.col("consecutive_high")),
        )
        .when(
            by_risk,
            F.format_string(f"Risk score %.2f >= fallback threshold {rules.alert_risk}", risk),
        )
        .when(by_model, F.format_string("ML anomaly (score=%s) without rule-based HIGH", score))
    )
    lap_alerts = df.filter(F.col("clean_lap")).withColumns({"reason": reason, "risk_score": risk})
    return lap_alerts.filter(F.col("reason").isNotNull()).select(
        "year", "race_round", F.col("lap_number").alias("lap"), *ALERT_COLUMNS[1:]
    )


def newest_first(alert_rows: DataFrame, size: int, arrival: list[str] | None = None) -> DataFrame:
    """The last size alerts; arrival columns, if any, come before lap order."""
    order = [*(arrival or []), "year", "race_round", "lap", "driver_code"]
    return alert_rows.orderBy(*[F.desc(c) for c in order], "reason").limit(size)


def alert_log(alert_rows: DataFrame, rules: Rules = RULES) -> DataFrame:
    return newest_first(alert_rows, rules.alert_log_size)


def recent_alerts(alert_rows: DataFrame, rules: Rules = RULES) -> DataFrame:
    return newest_first(alert_rows, rules.alert_page_size)


def state_columns() -> list[Column]:
    return [F.col(source).alias(name) for name, source in STATE_FIELDS.items()]


def latest_state(df: DataFrame, arrival: list[str] | None = None) -> DataFrame:
    """State of each driver after its newest event: greatest arrival, then lap.

    A maximum over the whole row combines map-side, so a driver with many events is no hot spot.
    """
    order = [*(arrival or []), "lap_number"]
    key = F.struct(
        *[F.coalesce(F.col(c), F.lit(-1)).alias("_o_" + c) for c in order],
        *[F.col(c) for c in STATE_FIELDS],
    )
    best = df.groupBy(*LIVE_KEYS).agg(F.max(key).alias("_best"))
    return best.select(
        "year", "race_round", *[F.col("_best").getField(c).alias(c) for c in STATE_FIELDS]
    )


def driver_state(df: DataFrame) -> DataFrame:
    """Events with consecutive_high to one typed state row per driver and race."""
    return latest_state(df.select("year", "race_round", *state_columns()))


def history(df: DataFrame) -> DataFrame:
    """Distinct lap records per driver: a repeated record counts once, a changed one is kept."""
    lap = F.col("lap_number")
    return df.select(
        *LIVE_KEYS,
        lap.alias("lap"),
        *HISTORY_FIELDS,
        F.coalesce(lap.cast("double"), F.lit(0.0)).alias("order_key"),
    ).distinct()


def race_pointer(df: DataFrame, arrival: list[str] | None = None) -> DataFrame:
    """One row: the race and lap of the newest event."""
    order = [*(arrival or []), "year", "race_round", "lap_number", "race_name"]
    newest = df.agg(F.max(F.struct(*order)).alias("_best")).select("_best.*")
    return newest.select("race_name", "year", F.col("lap_number").alias("last_lap"))


def state_text(state: DataFrame) -> DataFrame:
    """All state fields as text: null empty, doubles with 6 decimals, booleans True/False."""

    def text(name: str) -> Column:
        kind, value = state.schema[name].dataType.typeName(), F.col(name)
        if kind == "double":
            shown = F.format_string("%.6f", value)
        elif kind == "boolean":
            shown = F.initcap(value.cast("string"))
        else:
            shown = value.cast("string")
        # format_string spells a null out, so the value itself decides.
        return F.when(value.isNull(), F.lit("")).otherwise(shown).alias(name)

    stamp = [text("timestamp")] if "timestamp" in state.columns else []
    return state.select("year", "race_round", *[text(c) for c in STATE_FIELDS], *stamp)


_BOARD_INTEGERS = ["lap_number", "stint", "consecutive_high"]
_BOARD_NUMBERS = [
    "tyre_life", "lap_time_sec", "pace_delta", "degradation_slope", "field_delta",
    "track_temp_c", "air_temp_c", "wind_speed", "anomaly_score",
]
_BOARD_FLAGS = ["rainfall", "is_anomaly"]
_BOARD_TEXT = ["constructor_key", "race_name", "compound"]
# Spellings of true in stored text.
_TRUE_TEXT = ["True", "true", "1"]


def read_state_text(text: DataFrame) -> DataFrame:
    """Stored text back to typed columns; unreadable or missing values get their defaults."""
    parsed = {}
    for name in _BOARD_TEXT:
        parsed[name] = F.coalesce(F.col(name), F.lit(""))
    for name in _BOARD_NUMBERS:
        parsed[name] = F.col(name).try_cast("double")
    for name in _BOARD_INTEGERS:
        whole = F.col(name).try_cast("double").try_cast("bigint")
        parsed[name] = F.coalesce(whole, F.lit(0)).cast("bigint")
    for name in _BOARD_FLAGS:
        parsed[name] = F.coalesce(F.col(name).isin(_TRUE_TEXT), F.lit(False))
    parsed["risk_score"] = F.coalesce(F.col("risk_score").try_cast("double"), F.lit(0.0))
    parsed["risk_status"] = F.coalesce(F.col("risk_status"), F.lit("INSUFFICIENT_DATA"))
    return text.withColumns(parsed).drop("humidity")


def driver_board(text: DataFrame) -> DataFrame:
    """Drivers by falling risk."""
    return read_state_text(text).orderBy(
        F.desc("risk_score"), "year", "race_round", "driver_code"
    )


def driver_trend(history_rows: DataFrame, driver: str) -> DataFrame:
    """Lap by lap record of one driver."""
    return history_rows.filter(F.col("driver_code") == driver).orderBy(
        "year", "race_round", "order_key"
    )


def with_race(header: DataFrame, race: DataFrame) -> DataFrame:
    """A header with name and lap of the race that the pointer names; both are one row."""
    pointer = race.select(F.struct("race_name", "last_lap")).scalar()
    return header.withColumn("_race", pointer).select(
        F.col("_race.race_name").alias("race_name"), F.col("_race.last_lap").alias("last_lap"),
        *[c for c in header.columns if c != "last_lap"],
    )


def live_header(state: DataFrame) -> DataFrame:
    """Drivers, last lap, mean conditions, any rain, current anomalies, last update if it is known."""
    updated = [F.max("timestamp").alias("updated_at")] if "timestamp" in state.columns else []
    return state.agg(
        *updated,
        F.count("*").alias("drivers"),
        F.max("lap_number").alias("last_lap"),
        F.avg("track_temp_c").alias("track_temp_c"),
        F.avg("air_temp_c").alias("air_temp_c"),
        F.avg("wind_speed").alias("wind_speed"),
        F.coalesce(F.bool_or("rainfall"), F.lit(False)).alias("wet"),
        F.count_if(F.col("is_anomaly")).alias("anomalies"),
    )
