"""A lap and weather corpus derived from a generic event stream.

Each user of the events table is a driver, each of their events a lap, twenty users a race. The
rules are those of FIXTURES.md; every row of the table is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlab.config import SCALE, Scale
from stintlab.functions import columns as C
from stintlab.operators.ordered import ranked


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SECONDS = """unix_micros(timestamp '1970-01-01 00:00:00Z'
    + (ts - timestamp_ntz '2024-01-01 00:00:00')) / 1e6D"""

_RACE = "cast(1 + floor(user_id / 20) AS int)"

# Event columns with the derived values that several lap columns use.
_BASIS = [
    "event_id", "user_id", "lap_number",
    f"{_RACE} AS race_round",
    "cast(1 + floor((lap_number - 1) / 15) AS bigint) AS stint",
    f"{_SECONDS} AS sec",
    "if(user_id % 13 <> 0, concat('Team ', user_id % 10), null) AS team",
    "if(event_id % 37 <> 0, 88D + least(value, 200D) / 20D, null) AS lap_time_sec",
]

_LAP = [
    "2024 AS year",
    "race_round",
    "concat('Race ', race_round) AS race_name",
    "'Race' AS session_name",
    "concat('D', user_id) AS driver_code",
    "cast(user_id AS string) AS driver_number",
    "team",
    "constructor_key",
    "lap_number",
    "lap_time_sec",
    "lap_time_sec * 0.3D AS sector1_sec",
    "lap_time_sec * 0.4D AS sector2_sec",
    "lap_time_sec * 0.3D AS sector3_sec",
    """CASE WHEN event_id % 251 = 0 THEN 'INTERMEDIATE'
            WHEN (user_id + stint) % 11 = 0 THEN null
            WHEN (user_id + stint) % 3 = 0 THEN 'SOFT'
            WHEN (user_id + stint) % 3 = 1 THEN 'MEDIUM'
            ELSE 'HARD' END AS compound""",
    """if(event_id % 41 <> 0,
          cast((lap_number - 1) % 15 + 1 + 10 * (user_id % 2) AS double), null) AS tyre_life""",
    "stint",
    "if(lap_number % 15 = 0, sec, null) AS pit_in_time",
    "if(lap_number % 15 = 1 AND lap_number > 1, sec, null) AS pit_out_time",
    """CASE WHEN event_id % 29 = 0 THEN null WHEN event_id % 23 = 0 THEN '24'
            WHEN event_id % 19 = 0 THEN '67' WHEN event_id % 7 = 0 THEN '12'
            ELSE '1' END AS track_status""",
    "if(event_id % 31 <> 0, event_id % 17 <> 0, null) AS is_accurate",
    "sec AS lap_start_time_sec",
    "event_id",
]

_WEATHER = [
    "2024 AS year",
    f"{_RACE} AS race_round",
    f"{_SECONDS} AS t_sec",
    "cast(15 + k % 15 AS double) AS air_temp_c",
    "cast(25 + k % 20 AS double) AS track_temp_c",
    "cast(40 + k % 50 AS double) AS humidity",
    "cast(1000 + k % 20 AS double) AS pressure",
    "k % 13 = 0 AS rainfall",
    "cast(k % 8 AS double) + 0.5D AS wind_speed",
    "cast((k * 37) % 360 AS double) AS wind_direction",
]


def laps_of(events: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """The 21 lap columns plus event_id."""
    numbered = ranked(events, ["user_id"], ["ts", "event_id"], "lap_number", scale)
    basis = numbered.selectExpr(*_BASIS)
    return basis.withColumn("constructor_key", C.slug(F.col("team"))).selectExpr(*_LAP)


def weather_of(events: DataFrame) -> DataFrame:
    views = events.filter("event_type = 'view'")
    return views.selectExpr(
        "ts", "user_id", "cast(get_json_object(props, '$.k') AS int) AS k"
    ).selectExpr(*_WEATHER)

