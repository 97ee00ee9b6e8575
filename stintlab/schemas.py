"""Column lists and schemas shared by batch and streaming.

Fixed values: names, types and order are the interchange format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# Columns of a raw session table before renaming.
RAW_COLUMNS = [
    "Driver", "DriverNumber", "Team", "LapNumber", "LapTime",
    "Sector1Time", "Sector2Time", "Sector3Time", "Compound", "TyreLife",
    "Stint", "PitInTime", "PitOutTime", "TrackStatus", "IsAccurate", "LapStartTime",
]

LAP_DDL = """
    year int, race_round int, race_name string, session_name string,
    driver_code string, driver_number string, team string, constructor_key string,
    lap_number bigint, lap_time_sec double,
    sector1_sec double, sector2_sec double, sector3_sec double,
    compound string, tyre_life double, stint bigint,
    pit_in_time double, pit_out_time double,
    track_status string, is_accurate boolean, lap_start_time_sec double
"""

# Raw weather column -> lap table column.
WEATHER_NAMES = {
    "AirTemp": "air_temp_c",
    "TrackTemp": "track_temp_c",
    "Humidity": "humidity",
    "Pressure": "pressure",
    "Rainfall": "rainfall",
    "WindSpeed": "wind_speed",
    "WindDirection": "wind_direction",
}

WEATHER_DDL = """
    air_temp_c double, track_temp_c double, humidity double, pressure double,
    rainfall boolean, wind_speed double, wind_direction double
"""

EVENT_DDL = """
    year int, race_round int, race_name string, driver_code string, driver_number string,
    team string, constructor_key string, lap_number bigint, lap_time_sec double,
    sector1_sec double, sector2_sec double, sector3_sec double,
    compound string, tyre_life double, stint bigint, stint_lap_number bigint,
    clean_lap boolean, clean_laps_in_stint_so_far bigint, tyre_age_bucket string,
    rolling_3_lap_avg double, rolling_5_lap_avg double, previous_5_lap_avg double,
    pace_delta double, field_median_lap_time double, field_delta double,
    degradation_slope_3 double, degradation_slope_5 double, driver_vs_field_delta double,
    compound_baseline_delta double, compound_baseline_slope double,
    pace_component double, slope_component double, field_component double,
    risk_score double, risk_status string,
    air_temp_c double, track_temp_c double, humidity double, rainfall boolean,
    wind_speed double, anomaly_score double, is_anomaly boolean, event_time string
"""

# Inputs of the anomaly model, in model order.
ANOMALY_FEATURES = [
    "pace_delta", "field_delta", "tyre_life",
    "track_temp_c", "air_temp_c", "humidity", "wind_speed",
]

STINT_KEYS = ["year", "race_round", "driver_code", "stint"]
LAP_ORDER = ["lap_number"]
FIELD_KEYS = ["year", "race_round", "lap_number"]
BASELINE_KEYS = ["year", "race_round", "compound", "tyre_age_bucket"]
LIVE_KEYS = ["year", "race_round", "driver_code"]


def struct_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def names_of(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.replace("\n", " ").split(",")]


def require(df: DataFrame, columns: list[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
