"""Data-quality, corpus and analytical reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlab.config import RULES, SCALE, Rules, Scale
from stintlab.operators.quantiles import exact_quantiles
from stintlab.sources.tables import stage


def _clean(df: DataFrame) -> DataFrame:
    return df.filter(F.col("clean_lap"))


def _mean(name: str, digits: int = 3) -> Column:
    return F.round(F.avg(name), digits)


def _mean_time(name: str, digits: int = 3) -> Column:
    """Mean of times, which are whole microseconds: the sum is exact, so its order is no matter."""
    exact = F.sum(F.col(name).cast("decimal(18,6)")).cast("double")
    return F.round(exact / F.count(name), digits)


def lap_quality(features: DataFrame) -> DataFrame:
    """Rows, clean rows and clean share in percent."""
    clean = F.count_if(F.col("clean_lap"))
    share = 100.0 * clean / F.greatest(F.count("*"), F.lit(1))
    return features.agg(
        F.count("*").alias("laps"), clean.alias("clean_laps"), share.alias("clean_pct")
    )


def laps_by(features: DataFrame, key: str) -> DataFrame:
    return features.groupBy(key).agg(F.count("*").alias("laps"))


def laps_by_compound(features: DataFrame) -> DataFrame:
    return laps_by(features, "compound").orderBy(F.desc("laps"), "compound")


def laps_by_driver(features: DataFrame) -> DataFrame:
    return laps_by(features, "driver_code").orderBy("driver_code")


def short_stints(features: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Stints with too few clean laps to score."""
    return (
        features.groupBy("driver_code", "race_name", "stint", "compound")
        .agg(F.sum(F.col("clean_lap").cast("int")).alias("clean_laps"))
        .filter(F.col("clean_laps") < rules.min_clean_laps)
        .orderBy("driver_code", "stint", "race_name", "compound")
    )


def ingest_profile(laps: DataFrame) -> DataFrame:
    """One pass over ingested laps: counts, gaps, ranges."""

    def missing(name: str) -> Column:
        return F.count_if(F.col(name).isNull())

    return laps.agg(
        F.count("*").alias("laps"),
        F.countDistinct("driver_code").alias("drivers"),
        missing("lap_time_sec").alias("missing_lap_time"),
        missing("compound").alias("missing_compound"),
        missing("tyre_life").alias("missing_tyre_life"),
        F.min("lap_number").alias("first_lap"),
        F.max("lap_number").alias("last_lap"),
        F.countDistinct("compound").alias("compounds"),
        F.min("track_temp_c").alias("min_track_temp_c"),
        F.max("track_temp_c").alias("max_track_temp_c"),
        missing("track_temp_c").alias("missing_track_temp"),
        F.count_if(F.col("rainfall")).alias("wet_laps"),
    )


def distinct_values(laps: DataFrame, name: str) -> DataFrame:
    """Known values of a column, as rows."""
    return laps.select(name).filter(F.col(name).isNotNull()).distinct().orderBy(name)


def risk_distribution(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("risk_status")
        .agg(F.count("*").alias("laps"))
        .orderBy(F.desc("laps"), "risk_status")
    )


def slope_sample(events: DataFrame, rows: int = 10) -> DataFrame:
    """First clean laps that have a slope."""
    return (
        _clean(events)
        .filter(F.col("degradation_slope_5").isNotNull())
        .select(
            "year", "race_round", "driver_code", "stint", "lap_number", "stint_lap_number",
            "lap_time_sec", "degradation_slope_5", "risk_score", "risk_status",
        )
        .orderBy("driver_code", "lap_number", "year", "race_round")
        .limit(rows)
    )


def anomaly_report(scored: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """Scored rows, anomalies, rate and score percentiles in one row."""
    points = {"p1": 0.01, "p5": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    known = scored.filter(F.col("anomaly_score").isNotNull()).select("anomaly_score", "is_anomaly")
    # Scores are read twice, so the model runs once and its scores are kept.
    known = stage(known)
    out = known.agg(F.count("*").alias("scored"), F.count_if(F.col("is_anomaly")).alias("anomalies"))
    rate = 100.0 * F.col("anomalies") / F.greatest(F.col("scored"), F.lit(1))
    found = exact_quantiles(known, "anomaly_score", list(points.values()), scale)
    return out.select(
        "scored", "anomalies", rate.alias("rate_pct"),
        *[F.lit(v).cast("double").alias(n) for n, v in zip(points, found)],
    )


def anomaly_by_compound(scored: DataFrame) -> DataFrame:
    """Anomaly rate of scored rows with a known compound."""
    anomalies = F.count_if(F.col("is_anomaly"))
    return (
        scored.filter(F.col("anomaly_score").isNotNull() & F.col("compound").isNotNull())
        .groupBy("compound")
        .agg(
            anomalies.alias("anomalies"),
            F.count("*").alias("scored"),
            (100.0 * anomalies / F.greatest(F.count("*"), F.lit(1))).alias("rate_pct"),
        )
    )


def replay_summary(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count("*").alias("laps"),
        F.countDistinct("driver_code").alias("drivers"),
        F.min("lap_number").alias("first_lap"),
        F.max("lap_number").alias("last_lap"),
    )


def replay_groups(events: DataFrame) -> DataFrame:
    """Messages each replay step sends."""
    return events.groupBy("lap_number").agg(F.count("*").alias("messages")).orderBy("lap_number")


def corpus_summary(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count("*").alias("lap_rows"),
        F.countDistinct(F.struct("year", "race_round")).alias("races"),
        F.countDistinct("driver_code").alias("drivers"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )


def driver_pace(features: DataFrame) -> DataFrame:
    """Driver pace by race over clean laps."""
    return (
        _clean(features)
        .groupBy("year", "race_name", "driver_code")
        .agg(
            F.count("*").alias("clean_laps"),
            _mean_time("lap_time_sec").alias("avg_lap_time"),
            _mean("pace_delta").alias("avg_pace_delta"),
        )
        .orderBy("year", "race_name", "avg_lap_time", "driver_code")
    )


def compound_temp(features: DataFrame) -> DataFrame:
    """Clean-lap pace by compound and 5-degree track temperature bucket."""
    bucket = (F.floor(F.col("track_temp_c") / 5) * 5).cast("int")
    return (
        _clean(features)
        .filter(F.col("track_temp_c").isNotNull())
        .groupBy("compound", bucket.alias("track_temp_bucket"))
        .agg(
            F.count("*").alias("n"),
            _mean_time("lap_time_sec").alias("avg_lap_time"),
            _mean("pace_delta").alias("avg_pace_delta"),
        )
        .orderBy("compound", "track_temp_bucket")
    )


def top_anomalies(events: DataFrame, rows: int = 25) -> DataFrame:
    """Anomalies with the lowest scores."""
    return (
        events.filter(F.col("is_anomaly"))
        .orderBy(F.asc_nulls_last("anomaly_score"), "year", "race_round", "driver_code", "lap_number")
        .limit(rows)
        .select(
            "year", "race_name", "driver_code", "lap_number", "compound", "tyre_life",
            F.round("risk_score", 3).alias("risk_score"),
            "risk_status",
            F.round("anomaly_score", 4).alias("anomaly_score"),
        )
    )


def stint_lengths(features: DataFrame) -> DataFrame:
    """Distribution of laps per stint, by compound."""
    per_stint = features.groupBy("year", "race_round", "driver_code", "stint", "compound").agg(
        F.count("*").alias("laps_in_stint")
    )
    return (
        per_stint.groupBy("compound")
        .agg(
            F.count("*").alias("stints"),
            _mean("laps_in_stint", 2).alias("avg_length"),
            F.min("laps_in_stint").alias("min_length"),
            F.max("laps_in_stint").alias("max_length"),
        )
        .orderBy(F.desc("avg_length"), "compound")
    )


def risk_by_compound(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("compound", "risk_status")
        .agg(F.count("*").alias("n"))
        .orderBy("compound", F.desc("n"), "risk_status")
    )


def wet_dry(features: DataFrame) -> DataFrame:
    """Clean lap time in the wet and in the dry, by compound."""
    return (
        _clean(features)
        .groupBy("compound", "rainfall")
        .agg(F.count("*").alias("n"), _mean_time("lap_time_sec").alias("avg_lap_time"))
        .orderBy("compound", "rainfall")
    )


def clean_by_compound(features: DataFrame) -> DataFrame:
    return laps_by(_clean(features), "compound")
