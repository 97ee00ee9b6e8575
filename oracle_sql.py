"""Independent SQL for every registered query, written against the raw tables.

Each query is a final SELECT over named common table expressions; `sql(...)` puts the ones it
needs in front. Doubles are rounded to 6 digits on both sides.
"""

from __future__ import annotations

CTES: dict[str, str] = {}

CTES["ev"] = """
SELECT *, 1 + cast(floor(user_id / 20) AS int) AS rr,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS lap,
       (epoch_us(ts) - 1704067200000000) / 1e6 AS sec
FROM events
"""

CTES["laps"] = r"""
SELECT cast(2024 AS int) AS year, cast(rr AS int) AS race_round,
       'Race ' || cast(rr AS varchar) AS race_name, 'Race' AS session_name,
       'D' || cast(user_id AS varchar) AS driver_code,
       cast(user_id AS varchar) AS driver_number,
       team,
       translate(lower(regexp_replace(team, '^\s+|\s+$', '', 'g')), ' -/', '___') AS constructor_key,
       cast(lap AS bigint) AS lap_number,
       lap_time_sec,
       lap_time_sec * 0.3::double AS sector1_sec,
       lap_time_sec * 0.4::double AS sector2_sec,
       lap_time_sec * 0.3::double AS sector3_sec,
       CASE WHEN event_id % 251 = 0 THEN 'INTERMEDIATE'
            WHEN (user_id + stint) % 11 = 0 THEN NULL
            WHEN (user_id + stint) % 3 = 0 THEN 'SOFT'
            WHEN (user_id + stint) % 3 = 1 THEN 'MEDIUM'
            ELSE 'HARD' END AS compound,
       CASE WHEN event_id % 41 <> 0
            THEN cast((lap - 1) % 15 + 1 + 10 * (user_id % 2) AS double) END AS tyre_life,
       stint,
       CASE WHEN lap % 15 = 0 THEN sec END AS pit_in_time,
       CASE WHEN lap % 15 = 1 AND lap > 1 THEN sec END AS pit_out_time,
       CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 23 = 0 THEN '24'
            WHEN event_id % 19 = 0 THEN '67' WHEN event_id % 7 = 0 THEN '12' ELSE '1' END AS track_status,
       CASE WHEN event_id % 31 <> 0 THEN event_id % 17 <> 0 END AS is_accurate,
       sec AS lap_start_time_sec,
       event_id
FROM (
    SELECT *, cast(1 + floor((lap - 1) / 15) AS bigint) AS stint,
           CASE WHEN user_id % 13 <> 0 THEN 'Team ' || cast(user_id % 10 AS varchar) END AS team,
           CASE WHEN event_id % 37 <> 0 THEN 88 + least(value, 200) / 20 END AS lap_time_sec
    FROM ev
)
"""

CTES["weather"] = """
SELECT 2024 AS year, cast(rr AS int) AS race_round, sec AS t_sec,
       cast(15 + k % 15 AS double) AS air_temp_c,
       cast(25 + k % 20 AS double) AS track_temp_c,
       cast(40 + k % 50 AS double) AS humidity,
       cast(1000 + k % 20 AS double) AS pressure,
       k % 13 = 0 AS rainfall,
       cast(k % 8 AS double) + 0.5::double AS wind_speed,
       cast((k * 37) % 360 AS double) AS wind_direction
FROM (SELECT *, cast(json_extract_string(props, '$.k') AS int) AS k FROM ev WHERE event_type = 'view')
"""

CTES["lapw"] = """
SELECT l.*, w.air_temp_c, w.track_temp_c, w.humidity, w.pressure, w.rainfall, w.wind_speed, w.wind_direction
FROM laps l ASOF LEFT JOIN weather w
  ON l.year = w.year AND l.race_round = w.race_round AND l.lap_start_time_sec >= w.t_sec
"""

CTES["flagged"] = """
SELECT *,
       lap_number >= 2 AND lap_time_sec IS NOT NULL AND pit_in_time IS NULL AND pit_out_time IS NULL
         AND coalesce(is_accurate, false)
         AND (track_status IS NULL OR NOT regexp_matches(track_status, '[4567]')) AS clean_lap,
       CASE WHEN tyre_life >= 0 AND tyre_life <= 5 THEN '0-5'
            WHEN tyre_life >= 6 AND tyre_life <= 10 THEN '6-10'
            WHEN tyre_life >= 11 AND tyre_life <= 15 THEN '11-15'
            WHEN tyre_life >= 16 AND tyre_life <= 20 THEN '16-20'
            WHEN tyre_life >= 21 AND tyre_life <= 999 THEN '21+' END AS tyre_age_bucket
FROM lapw
"""

CTES["windowed"] = """
SELECT *, lap_time_sec - previous_5_lap_avg AS pace_delta
FROM (
    SELECT *,
           cast(row_number() OVER s AS bigint) AS stint_lap_number,
           cast(sum(cast(clean_lap AS int)) OVER (s ROWS UNBOUNDED PRECEDING) AS bigint)
             AS clean_laps_in_stint_so_far,
           avg(CASE WHEN clean_lap THEN lap_time_sec END)
             OVER (s ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3_lap_avg,
           avg(CASE WHEN clean_lap THEN lap_time_sec END)
             OVER (s ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS rolling_5_lap_avg,
           avg(CASE WHEN clean_lap THEN lap_time_sec END)
             OVER (s ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS previous_5_lap_avg
    FROM flagged
    WINDOW s AS (PARTITION BY year, race_round, driver_code, stint ORDER BY lap_number)
)
"""

CTES["feat"] = """
SELECT f.*, m.field_median_lap_time, f.lap_time_sec - m.field_median_lap_time AS field_delta
FROM windowed f LEFT JOIN (
    SELECT year, race_round, lap_number,
           quantile_disc(lap_time_sec, 0.5) FILTER (WHERE clean_lap) AS field_median_lap_time
    FROM windowed GROUP BY ALL
) m USING (year, race_round, lap_number)
"""

CTES["sloped"] = """
SELECT f.*, s.degradation_slope_3, s.degradation_slope_5
FROM feat f LEFT JOIN (
    SELECT year, race_round, driver_code, stint, lap_number,
           CASE WHEN count(*) OVER w3 >= 3
                THEN regr_slope(lap_time_sec, cast(stint_lap_number AS double)) OVER w3 END AS degradation_slope_3,
           CASE WHEN count(*) OVER w5 >= 5
                THEN regr_slope(lap_time_sec, cast(stint_lap_number AS double)) OVER w5 END AS degradation_slope_5
    FROM feat WHERE clean_lap
    WINDOW w3 AS (PARTITION BY year, race_round, driver_code, stint ORDER BY lap_number
                  ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
           w5 AS (PARTITION BY year, race_round, driver_code, stint ORDER BY lap_number
                  ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
) s USING (year, race_round, driver_code, stint, lap_number)
"""

CTES["base"] = """
SELECT year, race_round, compound, tyre_age_bucket,
       quantile_disc(lap_time_sec, 0.5) AS median_lap_time_sec,
       quantile_disc(pace_delta, 0.5) AS median_pace_delta,
       quantile_disc(degradation_slope_5, 0.5) AS median_degradation_slope,
       stddev_pop(pace_delta) AS std_pace_delta,
       stddev_pop(degradation_slope_5) AS std_degradation_slope,
       count(*) AS sample_count
FROM sloped WHERE clean_lap GROUP BY ALL
"""

_ROLL = """avg(median_pace_delta) AS median_pace_delta, avg(median_degradation_slope) AS median_degradation_slope,
       avg(std_pace_delta) AS std_pace_delta, avg(std_degradation_slope) AS std_degradation_slope,
       cast(sum(sample_count) AS bigint) AS sample_count"""

CTES["by_rc"] = f"SELECT year, race_round, compound, {_ROLL} FROM base GROUP BY year, race_round, compound"
CTES["by_ca"] = f"SELECT compound, tyre_age_bucket, {_ROLL} FROM base GROUP BY compound, tyre_age_bucket"
CTES["by_g"] = f"SELECT {_ROLL} FROM base"

CTES["fielded"] = """
SELECT s.*, b.field_median_degradation_slope, b.field_median_pace_delta,
       b.field_std_degradation_slope, b.field_std_pace_delta,
       s.degradation_slope_5 - b.field_median_degradation_slope AS driver_vs_field_delta
FROM sloped s LEFT JOIN (
    SELECT year, race_round, lap_number,
           quantile_disc(degradation_slope_5, 0.5) FILTER (WHERE clean_lap) AS field_median_degradation_slope,
           quantile_disc(pace_delta, 0.5) FILTER (WHERE clean_lap) AS field_median_pace_delta,
           stddev_pop(degradation_slope_5) FILTER (WHERE clean_lap) AS field_std_degradation_slope,
           stddev_pop(pace_delta) FILTER (WHERE clean_lap) AS field_std_pace_delta
    FROM sloped GROUP BY ALL
) b USING (year, race_round, lap_number)
"""


def _tiers(measure: str) -> str:
    return (
        f"coalesce(CASE WHEN b.sample_count >= 5 THEN b.{measure} END, "
        f"CASE WHEN rc.sample_count >= 5 THEN rc.{measure} END, "
        f"CASE WHEN ca.sample_count >= 5 THEN ca.{measure} END, g.{measure})"
    )


CTES["attached"] = f"""
SELECT *, pace_delta - baseline_pace_delta AS compound_baseline_delta,
       degradation_slope_5 - baseline_degradation_slope AS compound_baseline_slope
FROM (
    SELECT f.*, {_tiers("median_pace_delta")} AS baseline_pace_delta,
           {_tiers("median_degradation_slope")} AS baseline_degradation_slope,
           {_tiers("std_pace_delta")} AS baseline_std_pace_delta,
           {_tiers("std_degradation_slope")} AS baseline_std_degradation_slope
    FROM fielded f
    LEFT JOIN base b ON f.year = b.year AND f.race_round = b.race_round
         AND f.compound = b.compound AND f.tyre_age_bucket = b.tyre_age_bucket
    LEFT JOIN by_rc rc ON f.year = rc.year AND f.race_round = rc.race_round AND f.compound = rc.compound
    LEFT JOIN by_ca ca ON f.compound = ca.compound AND f.tyre_age_bucket = ca.tyre_age_bucket
    CROSS JOIN by_g g
)
"""


def _z(num: str, std: str) -> str:
    return f"greatest(0e0, least(1e0, CASE WHEN {std} > 0 THEN {num} / {std} ELSE 0e0 END))"


# The small forest: path length of each tree, written out.
CTES["paths"] = """
SELECT *, CASE WHEN pace_delta < 0.5e0 THEN CASE WHEN tyre_life < 12 THEN 3e0 ELSE 2.5e0 END ELSE 1.5e0 END AS t0,
       CASE WHEN field_delta < 0.5e0 THEN 2e0 WHEN pace_delta < -1 THEN 2.25e0 ELSE 3.5e0 END AS t1,
       CASE WHEN tyre_life < 20 THEN CASE WHEN pace_delta < 3 THEN 4e0 ELSE 2e0 END ELSE 1e0 END AS t2
FROM feat
"""
_C8 = "(2e0 * (ln(7e0) + 0.5772156649015329e0) - 14e0 / 8e0)"
CTES["scored"] = f"""
SELECT year, race_round, driver_code, stint, lap_number,
       CASE WHEN pace_delta IS NOT NULL AND tyre_life IS NOT NULL AND field_delta IS NOT NULL
            THEN -pow(2e0, -((t0 + t1 + t2) / 3e0) / {_C8}) END AS score
FROM paths
"""

CTES["risk"] = f"""
SELECT r.*, s.score AS anomaly_score, coalesce(s.score < -0.6e0, false) AS is_anomaly
FROM rated r LEFT JOIN scored s USING (year, race_round, driver_code, stint, lap_number)
"""

CTES["rated"] = f"""
SELECT *, CASE WHEN clean_laps_in_stint_so_far < 3 THEN 'INSUFFICIENT_DATA'
               WHEN risk_score >= 0.7e0 THEN 'HIGH' WHEN risk_score >= 0.4e0 THEN 'MEDIUM' ELSE 'LOW' END AS risk_status
FROM (
    SELECT *, greatest(0e0, least(1e0, 0.4e0 * pace_component + 0.4e0 * slope_component
                                       + 0.2e0 * field_component)) AS risk_score
    FROM (
        SELECT *, {_z("compound_baseline_delta", "baseline_std_pace_delta")} AS pace_component,
               {_z("compound_baseline_slope", "baseline_std_degradation_slope")} AS slope_component,
               {_z("field_delta", "field_std_pace_delta")} AS field_component
        FROM attached
    )
)
"""

CTES["runs"] = """
SELECT *, CASE WHEN up THEN sum(cast(up AS int)) OVER (PARTITION BY year, race_round, driver_code, island) ELSE 0 END
          AS whole_run,
       CASE WHEN up THEN row_number() OVER (PARTITION BY year, race_round, driver_code, island, up ORDER BY lap_number)
            ELSE 0 END AS consecutive_high
FROM (
    SELECT *, sum(CASE WHEN up THEN 0 ELSE 1 END)
              OVER (PARTITION BY year, race_round, driver_code ORDER BY lap_number ROWS UNBOUNDED PRECEDING) AS island
    FROM (SELECT *, coalesce(risk_status = 'HIGH' AND clean_lap, false) AS up FROM risk)
)
"""

CTES["alerting"] = """
SELECT *, CASE WHEN by_run THEN 'HIGH risk for ' || cast(consecutive_high AS varchar) || ' consecutive clean laps'
               WHEN by_risk THEN 'Risk score ' || printf('%.2f', shown_risk) || ' >= fallback threshold 0.8'
               ELSE 'ML anomaly (score=' || printf('%.6f', anomaly_score) || ') without rule-based HIGH' END AS reason
FROM (
    SELECT *, coalesce(risk_score, 0) AS shown_risk,
           consecutive_high >= 2 AS by_run, coalesce(risk_score, 0) >= 0.8e0 AS by_risk
    FROM runs WHERE clean_lap
)
WHERE by_run OR by_risk OR (is_anomaly AND risk_status <> 'HIGH')
"""

CTES["state"] = """
SELECT * FROM runs
QUALIFY row_number() OVER (PARTITION BY year, race_round, driver_code ORDER BY lap_number DESC) = 1
"""

NEEDS = {
    "ev": [], "laps": ["ev"], "weather": ["ev"], "lapw": ["laps", "weather"], "flagged": ["lapw"],
    "windowed": ["flagged"], "feat": ["windowed"], "sloped": ["feat"], "base": ["sloped"],
    "by_rc": ["base"], "by_ca": ["base"], "by_g": ["base"], "fielded": ["sloped"],
    "attached": ["fielded", "base", "by_rc", "by_ca", "by_g"], "rated": ["attached"],
    "paths": ["feat"], "scored": ["paths"], "risk": ["rated", "scored"],
    "runs": ["risk"], "alerting": ["runs"], "state": ["runs"],
}


def _closure(names: list[str]) -> list[str]:
    found: list[str] = []

    def visit(name: str) -> None:
        for other in NEEDS[name]:
            visit(other)
        if name not in found:
            found.append(name)

    for name in names:
        visit(name)
    return found


def sql(select: str, *needs: str, **extra: str) -> str:
    """A statement: the needed expressions (and any extra ones), then the select."""
    parts = {n: CTES[n] for n in _closure(list(needs))} | extra
    if not parts:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({body})" for n, body in parts.items()) + "\n" + select


def r6(expr: str, name: str | None = None, digits: int = 6) -> str:
    """Reports round the number as written, half up; all else is compared to 6 digits, as the catalog shows it."""
    if digits == 6:
        return f"floor(cast({expr} AS double) * 1e6 + 0.5001e0) / 1e6 AS {name or expr}"
    return f"cast(round(cast(cast({expr} AS varchar) AS decimal(38, 15)), {digits}) AS double) AS {name or expr}"


_MEAN_TIME = "cast(sum(cast(lap_time_sec AS decimal(18, 6))) AS double) / count(lap_time_sec)"


def r6s(names: str, prefix: str = "") -> str:
    return ", ".join(r6(prefix + n, n) for n in names.split())


_KEY = "year, race_round, driver_code, stint, lap_number"
_LAP_TEXT = (
    "year, race_round, race_name, session_name, driver_code, driver_number, team, "
    "constructor_key, lap_number, compound, track_status, is_accurate"
)
_LAP_DOUBLES = (
    "lap_time_sec sector1_sec sector2_sec sector3_sec tyre_life pit_in_time pit_out_time "
    "lap_start_time_sec"
)
_WEATHER = "air_temp_c track_temp_c humidity pressure wind_speed wind_direction"
_ROLLING = "rolling_3_lap_avg rolling_5_lap_avg previous_5_lap_avg pace_delta"
_CHOSEN = (
    "baseline_pace_delta baseline_degradation_slope baseline_std_pace_delta "
    "baseline_std_degradation_slope"
)
_MEASURES = "median_pace_delta median_degradation_slope std_pace_delta std_degradation_slope"
_EVENT_DOUBLES = (
    "lap_time_sec sector1_sec sector2_sec sector3_sec tyre_life " + _ROLLING
    + " field_median_lap_time field_delta degradation_slope_3 degradation_slope_5 "
    "driver_vs_field_delta compound_baseline_delta compound_baseline_slope pace_component "
    "slope_component field_component risk_score air_temp_c track_temp_c humidity wind_speed "
    "anomaly_score"
)
_EVENT_REST = (
    "year, race_round, race_name, driver_code, driver_number, team, constructor_key, lap_number, "
    "compound, stint, stint_lap_number, clean_lap, clean_laps_in_stint_so_far, tyre_age_bucket, "
    "risk_status, rainfall, is_anomaly"
)
_STATE_DOUBLES = (
    "tyre_life lap_time_sec pace_delta degradation_slope field_delta risk_score air_temp_c "
    "track_temp_c humidity wind_speed anomaly_score"
)
_STATE_TEXT = "driver_code constructor_key race_name compound risk_status"
_STATE_INTS = "lap_number stint consecutive_high"
_STATE_FLAGS = "rainfall is_anomaly"

_NAMED_STATE = """
SELECT year, race_round, driver_code, constructor_key, race_name, lap_number, compound, tyre_life, stint,
       lap_time_sec, pace_delta, degradation_slope_5 AS degradation_slope, field_delta, risk_score, risk_status,
       air_temp_c, track_temp_c, humidity, rainfall, wind_speed, anomaly_score, is_anomaly, consecutive_high
FROM state
"""


def _state_text() -> str:
    shown = {n: f"printf('%.6f', {n})" for n in _STATE_DOUBLES.split()}
    shown |= {n: n for n in _STATE_TEXT.split()}
    shown |= {n: f"cast({n} AS varchar)" for n in _STATE_INTS.split()}
    shown |= {n: f"CASE WHEN {n} THEN 'True' ELSE 'False' END" for n in _STATE_FLAGS.split()}
    return ", ".join(f"CASE WHEN {n} IS NULL THEN '' ELSE {e} END AS {n}" for n, e in shown.items())


def _state_read() -> str:
    numbers = [n for n in _STATE_DOUBLES.split() if n not in ("humidity", "risk_score")]
    parts = [r6(f"try_cast({n} AS double)", n) for n in numbers]
    parts.append(r6("coalesce(try_cast(risk_score AS double), 0)", "risk_score"))
    parts += [f"coalesce(cast(try_cast({n} AS double) AS bigint), 0) AS {n}" for n in _STATE_INTS.split()]
    parts += [f"{n} IN ('True', 'true', '1') AS {n}" for n in _STATE_FLAGS.split()]
    return ", ".join(parts + _STATE_TEXT.split())


def _known(names: str) -> str:
    return " AND ".join(f"{n} IS NOT NULL" for n in names.split())


def _race_keys(where: str) -> str:
    return f"SELECT DISTINCT year, race_round FROM laps WHERE {where}"


_SCHEDULE = "SELECT DISTINCT year, race_round - 1 AS round, race_name FROM laps"

_SWEEP = """
SELECT s.year, s.round AS race_round, s.race_name,
       CASE WHEN st.year IS NOT NULL THEN 'skipped' WHEN la.year IS NOT NULL THEN 'written' ELSE 'failed' END AS status
FROM schedule s
LEFT JOIN (SELECT DISTINCT year, race_round FROM laps WHERE race_round % 2 = 0) st
  ON s.year = st.year AND s.round = st.race_round
LEFT JOIN (SELECT DISTINCT year, race_round FROM laps WHERE race_round % 3 <> 0) la
  ON s.year = la.year AND s.round = la.race_round
WHERE s.round > 0
"""

_ALERT = f"year, race_round, lap_number AS lap, driver_code, compound, {r6('tyre_life')}, {r6('shown_risk', 'risk_score')}, reason"
_ALERT_ORDER = "year DESC, race_round DESC, lap_number DESC, driver_code DESC, reason"

_HISTORY = (
    "SELECT DISTINCT year, race_round, driver_code, lap_number AS lap, compound, risk_status, "
    + r6s("lap_time_sec risk_score pace_delta tyre_life")
    + ", cast(coalesce(lap_number, 0) AS double) AS order_key FROM risk"
)

_SLUG = r"translate(lower(regexp_replace({}, '^\s+|\s+$', '', 'g')), ' -/', '___')"

ORACLES: dict[str, str] = {
    "normalize_laps": sql(
        f"SELECT {_LAP_TEXT}, CASE WHEN event_id % 43 = 0 THEN NULL ELSE stint END AS stint, "
        f"{r6s(_LAP_DOUBLES)} FROM laps",
        "laps",
    ),
    "constructor_key": sql(
        f"SELECT team, count(*) AS laps, {_SLUG.format('team')} AS plain, "
        + _SLUG.format(r"' ' || chr(9) || team || '-A/B ' || chr(10)")
        + " AS padded FROM laps GROUP BY team",
        "laps",
    ),
    "ingest_skip_existing": sql(
        f"SELECT {_KEY} FROM laps ANTI JOIN ({_race_keys('race_round % 2 = 0')}) USING (year, race_round)",
        "laps",
    ),
    "race_rounds": sql("SELECT * FROM schedule WHERE round > 0", "laps", schedule=_SCHEDULE),
    "sweep_manifest": sql(_SWEEP, "laps", schedule=_SCHEDULE),
    "sweep_counts": sql(
        f"SELECT status, count(*) AS races FROM ({_SWEEP}) GROUP BY status", "laps", schedule=_SCHEDULE
    ),
    "corpus_by_year": sql(
        "SELECT year, count(DISTINCT race_round) AS races, count(*) AS laps FROM laps GROUP BY year", "laps"
    ),
    "asof_weather": sql(
        f"SELECT {_KEY}, rainfall, {r6s('lap_start_time_sec ' + _WEATHER)} FROM lapw", "lapw"
    ),
    "ingest_profile": sql(
        """SELECT count(*) AS laps, count(DISTINCT driver_code) AS drivers,
                  count(*) FILTER (WHERE lap_time_sec IS NULL) AS missing_lap_time,
                  count(*) FILTER (WHERE compound IS NULL) AS missing_compound,
                  count(*) FILTER (WHERE tyre_life IS NULL) AS missing_tyre_life,
                  min(lap_number) AS first_lap, max(lap_number) AS last_lap,
                  count(DISTINCT compound) AS compounds,
                  min(track_temp_c) AS min_track_temp_c, max(track_temp_c) AS max_track_temp_c,
                  count(*) FILTER (WHERE track_temp_c IS NULL) AS missing_track_temp,
                  count(*) FILTER (WHERE rainfall) AS wet_laps FROM lapw""",
        "lapw",
    ),
    "ingest_compounds": sql("SELECT DISTINCT compound FROM laps WHERE compound IS NOT NULL", "laps"),
    "ingest_drivers": sql("SELECT DISTINCT driver_code FROM laps", "laps"),
    "clean_lap": sql(f"SELECT {_KEY}, clean_lap FROM flagged", "flagged"),
    "tyre_age_bucket": sql(f"SELECT {_KEY}, tyre_life, tyre_age_bucket FROM flagged", "flagged"),
    "stint_counters": sql(
        f"SELECT {_KEY}, stint_lap_number, clean_laps_in_stint_so_far FROM windowed", "windowed"
    ),
    "rolling_pace": sql(f"SELECT {_KEY}, {r6s(_ROLLING)} FROM windowed", "windowed"),
    "field_median": sql(f"SELECT {_KEY}, {r6s('field_median_lap_time field_delta')} FROM feat", "feat"),
    "lap_features": sql(
        f"SELECT {_LAP_TEXT}, stint, rainfall, clean_lap, stint_lap_number, clean_laps_in_stint_so_far, "
        f"tyre_age_bucket, {r6s(' '.join([_LAP_DOUBLES, _WEATHER, _ROLLING, 'field_median_lap_time field_delta']))} FROM feat",
        "feat",
    ),
    "lap_quality_report": sql(
        "SELECT count(*) AS laps, count(*) FILTER (WHERE clean_lap) AS clean_laps, "
        + r6("100e0 * count(*) FILTER (WHERE clean_lap) / greatest(count(*), 1)", "clean_pct")
        + " FROM flagged",
        "flagged",
    ),
    "laps_by_compound": sql("SELECT compound, count(*) AS laps FROM laps GROUP BY compound", "laps"),
    "laps_by_driver": sql("SELECT driver_code, count(*) AS laps FROM laps GROUP BY driver_code", "laps"),
    "short_stints": sql(
        "SELECT driver_code, race_name, stint, compound, cast(sum(cast(clean_lap AS int)) AS bigint) AS clean_laps "
        "FROM flagged GROUP BY driver_code, race_name, stint, compound HAVING sum(cast(clean_lap AS int)) < 3",
        "flagged",
    ),
    "degradation_slopes": sql(
        f"SELECT {_KEY}, {r6s('degradation_slope_3 degradation_slope_5')} FROM sloped", "sloped"
    ),
    "compound_age_baselines": sql(
        f"SELECT year, race_round, compound, tyre_age_bucket, {r6s('median_lap_time_sec ' + _MEASURES)}, sample_count FROM base",
        "base",
    ),
    "field_baselines": sql(
        f"SELECT {_KEY}, "
        + r6s(
            "field_median_degradation_slope field_median_pace_delta field_std_degradation_slope "
            "field_std_pace_delta driver_vs_field_delta"
        )
        + " FROM fielded",
        "fielded",
    ),
    "field_statistics": sql(
        "SELECT year, race_round, lap_number, "
        + r6("quantile_disc(lap_time_sec, 0.5)", "field_median_lap_time") + ", "
        + r6("stddev_pop(pace_delta)", "field_std_pace_delta")
        + " FROM sloped WHERE clean_lap GROUP BY year, race_round, lap_number",
        "sloped",
    ),
    "baseline_rollups": sql(
        f"""SELECT 'race_compound' AS tier, year, race_round, compound, NULL AS tyre_age_bucket, {r6s(_MEASURES)}, sample_count FROM by_rc
            UNION ALL
            SELECT 'compound_age', NULL, NULL, compound, tyre_age_bucket, {r6s(_MEASURES)}, sample_count FROM by_ca
            UNION ALL
            SELECT 'global', NULL, NULL, NULL, NULL, {r6s(_MEASURES)}, NULL FROM by_g""",
        "by_rc", "by_ca", "by_g",
    ),
    "attach_baselines": sql(
        f"SELECT {_KEY}, {r6s(_CHOSEN + ' compound_baseline_delta compound_baseline_slope')} FROM attached", "attached"
    ),
    "risk_score": sql(
        f"SELECT {_KEY}, {r6s('pace_component slope_component field_component risk_score')}, risk_status FROM risk", "risk"
    ),
    "risk_distribution": sql("SELECT risk_status, count(*) AS laps FROM risk GROUP BY risk_status", "risk"),
    "slope_sample": sql(
        f"""SELECT {_KEY}, stint_lap_number, {r6s('lap_time_sec degradation_slope_5 risk_score')}, risk_status
            FROM (SELECT * FROM risk WHERE clean_lap AND degradation_slope_5 IS NOT NULL
                  ORDER BY driver_code, lap_number, year, race_round LIMIT 10)""",
        "risk",
    ),
    "replay_events": sql(f"SELECT {_EVENT_REST}, {r6s(_EVENT_DOUBLES)} FROM risk", "risk"),
    "anomaly_training_frame": sql(
        f"""SELECT {_KEY}, {r6s('pace_delta field_delta tyre_life track_temp_c air_temp_c humidity wind_speed')}
            FROM feat WHERE clean_lap AND {_known('pace_delta field_delta tyre_life track_temp_c air_temp_c humidity wind_speed')}""",
        "feat",
    ),
    "forest_scores": sql(
        f"SELECT {_KEY}, {r6('score', 'anomaly_score')}, coalesce(score < -0.6e0, false) AS is_anomaly FROM scored",
        "scored",
    ),
    "anomaly_no_model": sql(
        f"SELECT {_KEY}, cast(NULL AS double) AS anomaly_score, false AS is_anomaly FROM laps", "laps"
    ),
    "anomaly_report": sql(
        "SELECT count(*) AS scored, count(*) FILTER (WHERE is_anomaly) AS anomalies, "
        + r6("100e0 * count(*) FILTER (WHERE is_anomaly) / greatest(count(*), 1)", "rate_pct") + ", "
        + ", ".join(
            r6(f"quantile_cont(anomaly_score, {p})", n)
            for n, p in {"p1": 0.01, "p5": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}.items()
        )
        + " FROM risk WHERE anomaly_score IS NOT NULL",
        "risk",
    ),
    "anomaly_by_compound": sql(
        "SELECT compound, count(*) FILTER (WHERE is_anomaly) AS anomalies, count(*) AS scored, "
        + r6("100e0 * count(*) FILTER (WHERE is_anomaly) / greatest(count(*), 1)", "rate_pct")
        + " FROM risk WHERE anomaly_score IS NOT NULL AND compound IS NOT NULL GROUP BY compound",
        "risk",
    ),
    "top_anomalies": sql(
        f"""SELECT year, race_name, driver_code, lap_number, compound, tyre_life,
                   {r6('risk_score', digits=3)}, risk_status, {r6('anomaly_score', digits=4)}
            FROM (SELECT * FROM risk WHERE is_anomaly
                  ORDER BY anomaly_score, year, race_round, driver_code, lap_number LIMIT 25)""",
        "risk",
    ),
    "replay_filter": sql(f"SELECT {_KEY} FROM laps WHERE year = 2024 AND race_name = 'Race 1'", "laps"),
    "replay_filter_by_name": sql(f"SELECT {_KEY} FROM laps WHERE race_name = 'Race 1'", "laps"),
    "replay_messages": sql(
        f"SELECT driver_code AS key, {_EVENT_REST}, {r6s(_EVENT_DOUBLES)}, "
        "'2024-01-01T00:' || lpad(cast(lap_number % 60 AS varchar), 2, '0') || ':00+00:00' AS event_time FROM risk",
        "risk",
    ),
    "replay_until_lap": sql("SELECT driver_code AS key, lap_number FROM laps WHERE lap_number <= 20", "laps"),
    "parse_events": sql(
        f"""SELECT cast(event_id AS varchar) AS driver_number, driver_code,
                   CASE WHEN event_id % 10 = 2 THEN NULL ELSE stint END AS stint, lap_number,
                   {r6('risk_score')}, risk_status, clean_lap, '2024-01-01T00:00:00+00:00' AS event_time
            FROM risk WHERE event_id % 10 NOT IN (0, 1)""",
        "risk",
    ),
    "replay_summary": sql(
        "SELECT count(*) AS laps, count(DISTINCT driver_code) AS drivers, min(lap_number) AS first_lap, "
        "max(lap_number) AS last_lap FROM laps",
        "laps",
    ),
    "replay_groups": sql("SELECT lap_number, count(*) AS messages FROM laps GROUP BY lap_number", "laps"),
    "consecutive_high": sql(f"SELECT {_KEY}, risk_status, clean_lap, consecutive_high FROM runs", "runs"),
    "alerts": sql(f"SELECT {_ALERT} FROM alerting", "alerting"),
    "alerts_log": sql(f"SELECT {_ALERT} FROM (SELECT * FROM alerting ORDER BY {_ALERT_ORDER} LIMIT 200)", "alerting"),
    "recent_alerts": sql(
        f"SELECT {_ALERT.removeprefix('year, race_round, ')} FROM (SELECT * FROM alerting ORDER BY {_ALERT_ORDER} LIMIT 50)",
        "alerting",
    ),
    "driver_state": sql(
        f"SELECT year, race_round, {', '.join((_STATE_TEXT + ' ' + _STATE_INTS + ' ' + _STATE_FLAGS).split())}, "
        f"{r6s(_STATE_DOUBLES)} FROM named",
        "state", named=_NAMED_STATE,
    ),
    "state_text": sql(f"SELECT year, race_round, {_state_text()} FROM named", "state", named=_NAMED_STATE),
    "driver_board": sql(
        f"SELECT year, race_round, {_state_read()} FROM texts",
        "state", named=_NAMED_STATE, texts=f"SELECT year, race_round, {_state_text()} FROM named",
    ),
    "live_header": sql(
        "SELECT count(*) AS drivers, max(lap_number) AS last_lap, "
        + ", ".join(r6(f"avg({n})", n) for n in ("track_temp_c", "air_temp_c", "wind_speed"))
        + ", coalesce(bool_or(rainfall), false) AS wet, count(*) FILTER (WHERE is_anomaly) AS anomalies FROM state",
        "state",
    ),
    "driver_history": sql(_HISTORY, "risk"),
    "driver_trend": sql(_HISTORY + " WHERE driver_code = 'D7'", "risk"),
    "stream_history": sql(_HISTORY, "risk"),
    "race_current": sql(
        "SELECT race_name, year, lap_number AS last_lap FROM laps "
        "ORDER BY year DESC, race_round DESC, lap_number DESC, race_name DESC LIMIT 1",
        "laps",
    ),
    "corpus_summary": sql(
        "SELECT count(*) AS lap_rows, count(DISTINCT (year, race_round)) AS races, "
        "count(DISTINCT driver_code) AS drivers, min(year) AS first_year, max(year) AS last_year FROM laps",
        "laps",
    ),
    "driver_pace": sql(
        "SELECT year, race_name, driver_code, count(*) AS clean_laps, "
        + r6(_MEAN_TIME, "avg_lap_time", 3) + ", " + r6("avg(pace_delta)", "avg_pace_delta", 3)
        + " FROM windowed WHERE clean_lap GROUP BY year, race_name, driver_code",
        "windowed",
    ),
    "compound_temp": sql(
        "SELECT compound, cast(floor(track_temp_c / 5) * 5 AS int) AS track_temp_bucket, count(*) AS n, "
        + r6(_MEAN_TIME, "avg_lap_time", 3) + ", " + r6("avg(pace_delta)", "avg_pace_delta", 3)
        + " FROM windowed WHERE clean_lap AND track_temp_c IS NOT NULL GROUP BY ALL",
        "windowed",
    ),
    "stint_lengths": sql(
        f"""SELECT compound, count(*) AS stints, {r6('avg(n)', 'avg_length', 2)},
                   min(n) AS min_length, max(n) AS max_length
            FROM (SELECT compound, count(*) AS n FROM laps GROUP BY year, race_round, driver_code, stint, compound)
            GROUP BY compound""",
        "laps",
    ),
    "risk_by_compound": sql(
        "SELECT compound, risk_status, count(*) AS n FROM risk GROUP BY compound, risk_status", "risk"
    ),
    "wet_dry": sql(
        "SELECT compound, rainfall, count(*) AS n, " + r6(_MEAN_TIME, "avg_lap_time", 3)
        + " FROM flagged WHERE clean_lap GROUP BY compound, rainfall",
        "flagged",
    ),
    "clean_by_compound": sql("SELECT compound, count(*) AS laps FROM flagged WHERE clean_lap GROUP BY compound", "flagged"),
    "free_sql": sql("SELECT compound, count(*) AS laps FROM flagged WHERE clean_lap GROUP BY compound", "flagged"),
}

_STAMP = "'2024-01-01 00:00:00'"
ORACLES |= {
    "stream_state": sql(
        f"SELECT year, race_round, {_state_text()}, {_STAMP} AS timestamp FROM named", "state", named=_NAMED_STATE
    ),
    "stream_alerts": sql(
        f"SELECT {_ALERT}, {_STAMP} AS timestamp FROM (SELECT * FROM alerting ORDER BY {_ALERT_ORDER} LIMIT 200)", "alerting"
    ),
    "stream_header": sql(
        f"SELECT (SELECT race_name FROM newest) AS race_name, (SELECT last_lap FROM newest) AS last_lap, {_STAMP} AS updated_at, "
        "count(*) AS drivers, "
        + ", ".join(r6(f"avg({n})", n) for n in ("track_temp_c", "air_temp_c", "wind_speed"))
        + ", coalesce(bool_or(rainfall), false) AS wet, count(*) FILTER (WHERE is_anomaly) AS anomalies FROM state",
        "state", newest=ORACLES["race_current"].rpartition(")\n")[2],
    ),
    "stream_race": ORACLES["race_current"].replace("lap_number AS last_lap", f"lap_number AS last_lap, {_STAMP} AS updated_at"),
    "stream_metrics": sql(
        "SELECT (SELECT count(*) FROM laps) AS rows, (SELECT count(*) FROM alerting) AS alerts", "alerting"
    ),
    "stored_raw_laps": sql(f"SELECT {_LAP_TEXT}, stint, race_round AS round, {r6s(_LAP_DOUBLES)} FROM laps", "laps"),
    "stored_races": sql("SELECT DISTINCT year, race_round FROM laps", "laps"),
    "stored_inventory": ORACLES["corpus_by_year"],
    "stored_baselines": ORACLES["compound_age_baselines"],
    "stored_events": ORACLES["replay_events"],
    "saved_forest_scores": ORACLES["forest_scores"],
} | {
    f"report_{name}": ORACLES[name]
    for name in ("driver_pace", "compound_temp", "top_anomalies", "stint_lengths", "risk_by_compound", "wet_dry")
}


# --- the fitted forest: the same samples and splits from the same md5 texts ---------------------

_INPUTS = "pace_delta field_delta tyre_life track_temp_c air_temp_c humidity wind_speed"
_TREES, _SIZE = 200, 256


def _u(*parts: str) -> str:
    """A number in [0, 1) from the md5 of the parts, joined by colons."""
    text = " || ':' || ".join(f"cast({p} AS varchar)" for p in ("42", *parts))
    return f"(cast('0x' || substr(md5({text}), 1, 13) AS bigint) / 4503599627370496e0)"


def _split_of(lows: str, highs: str, source: str) -> str:
    """Adds feature and split of each row's node to a select that has its ranges; null for a leaf."""
    return f"""
SELECT *, CASE WHEN lows[feature] + {_u("tree", "node", "'split'")} * (highs[feature] - lows[feature]) > lows[feature]
               THEN lows[feature] + {_u("tree", "node", "'split'")} * (highs[feature] - lows[feature])
               ELSE highs[feature] END AS split
FROM (
    SELECT *, CASE WHEN depth < deepest AND len(varying) > 0
                   THEN varying[1 + cast(floor({_u("tree", "node", "'feature'")} * len(varying)) AS bigint)] END AS feature
    FROM (
        SELECT *, list_filter(range(1, 8), lambda i: highs[i] > lows[i]) AS varying
        FROM (SELECT *, {lows} AS lows, {highs} AS highs FROM {source})
    )
)"""


def _ranges(over: str) -> tuple[str, str]:
    return tuple("[" + ", ".join(f"{f}(v[{i}]) {over}" for i in range(1, 8)) + "]" for f in ("min", "max"))


_NODE_WINDOW = "OVER (PARTITION BY tree, node)"
_LOWS, _HIGHS = _ranges(_NODE_WINDOW)
_FOREST = {
    "inputs": f"""
SELECT row_number() OVER () AS id, year, race_round, driver_code, stint, lap_number, clean_lap,
       concat_ws('|', year, race_round, driver_code, stint, lap_number) AS key, [{_INPUTS.replace(" ", ", ")}] AS v
FROM feat WHERE {_known(_INPUTS)}""",
    "training": "SELECT * FROM inputs WHERE clean_lap",
    "shares": f"""
SELECT least({_SIZE}, n) AS size, cast(ceil(log2(least({_SIZE}, n))) AS int) AS deepest,
       least(1e0, 1.5e0 * least({_SIZE}, n) / n) AS share FROM (SELECT count(*) AS n FROM training)""",
    "samples": f"""
SELECT tree, v, deepest FROM (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY chance, key) AS place FROM (
        SELECT tree, key, v, size, deepest, share, {_u("tree", "key")} AS chance
        FROM training, shares, range({_TREES}) t(tree)
        WHERE {_u("'row'", "key")} < least(1e0, share * {_TREES})
    ) WHERE chance < share / least(1e0, share * {_TREES})
) WHERE place <= size""",
    "grown": f"""
SELECT tree, cast(0 AS bigint) AS node, 0 AS depth, deepest, v FROM samples
UNION ALL
SELECT tree, 2 * node + CASE WHEN v[feature] < split THEN 1 ELSE 2 END, depth + 1, deepest, v
FROM ({_split_of(_LOWS, _HIGHS, "grown")}) WHERE feature IS NOT NULL""",
    "nodes": f"""
SELECT tree, node, feature, split,
       depth + CASE WHEN n <= 1 THEN 0e0 WHEN n = 2 THEN 1e0
                    ELSE 2e0 * (ln(n - 1e0) + 0.5772156649015329e0) - 2e0 * (n - 1) / n END AS path
FROM ({_split_of("low", "high", "(SELECT tree, node, depth, deepest, count(*) AS n, " + _ranges("")[0] + " AS low, " + _ranges("")[1] + " AS high FROM grown GROUP BY tree, node, depth, deepest)")})""",
    "walk0": f"SELECT id, v, tree, cast(0 AS bigint) AS node FROM inputs, range({_TREES}) t(tree)",
} | {
    f"walk{i}": f"""
SELECT w.id, w.v, w.tree, CASE WHEN n.feature IS NULL THEN w.node WHEN w.v[n.feature] < n.split THEN 2 * w.node + 1
                               ELSE 2 * w.node + 2 END AS node
FROM walk{i - 1} w JOIN nodes n ON w.tree = n.tree AND w.node = n.node"""
    for i in range(1, 9)
} | {
    "totals": f"""
SELECT id, -pow(2e0, -round(sum(path), 9) / {_TREES} / (SELECT 2e0 * (ln(size - 1e0) + 0.5772156649015329e0) - 2e0 * (size - 1) / size FROM shares)) AS score
FROM walk8 w JOIN nodes n ON w.tree = n.tree AND w.node = n.node GROUP BY id""",
    "placed": "SELECT i.*, score FROM inputs i JOIN totals USING (id)",
    "fitted": f"""
SELECT f.year, f.race_round, f.driver_code, f.stint, f.lap_number, f.clean_lap, score,
       coalesce(score < (SELECT quantile_cont(score, 0.05) FROM placed WHERE clean_lap), false) AS anomalous
FROM feat f LEFT JOIN placed p USING (year, race_round, driver_code, stint, lap_number)""",
}


def _with_forest(select: str) -> str:
    return sql(select, "feat", **_FOREST).replace("WITH ", "WITH RECURSIVE ", 1)


ORACLES |= {
    "isolation_forest": _with_forest(
        f"SELECT {_KEY}, clean_lap, {r6('score', 'anomaly_score')}, anomalous AS is_anomaly FROM fitted"
    ),
    "isolation_forest_report": _with_forest(
        "SELECT count(*) AS scored, count(*) FILTER (WHERE anomalous) AS anomalies, "
        + r6("100e0 * count(*) FILTER (WHERE anomalous) / greatest(count(*), 1)", "rate_pct") + ", "
        + ", ".join(
            r6(f"quantile_cont(score, {p})", n)
            for n, p in {"p1": 0.01, "p5": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}.items()
        )
        + " FROM fitted WHERE clean_lap AND score IS NOT NULL"
    ),
}

# The order in which laps arrive changes nothing.
ORACLES |= {f"stream_shuffled_{name}": ORACLES[f"stream_{name}"] for name in ("state", "history")}
