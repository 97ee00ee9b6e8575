"""Batch plans: laps to features, features to replay events, and the stage-by-stage job."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stintlab.config import RULES, SCALE, Rules, Scale
from stintlab.operators import baselines as B
from stintlab.operators import forest as M
from stintlab.operators import laps as L
from stintlab.operators import slopes as S
from stintlab.operators.joins import lookup
from stintlab.operators.ordered import laid_by_driver, per_stint
from stintlab.operators.risk import add_risk_score
from stintlab.schemas import FIELD_KEYS
from stintlab.sources.laps import resolve_laps
from stintlab.sources.replay import race_is
from stintlab.sources.tables import staging, write_table

log = logging.getLogger("stintlab")


def stint_table(laps: DataFrame, rules: Rules = RULES, scale: Scale = SCALE) -> DataFrame:
    """All row-local and stint-window columns, slopes included, behind one shuffle by driver.

    The run counter and the live state, which go by driver, find their rows in place too.
    """
    flagged = L.add_tyre_age_bucket(L.add_clean_lap(laps, rules), rules)
    return per_stint(
        laid_by_driver(flagged, scale, counted=laps),
        lambda part: S.slopes_plain(L.stint_windows_plain(part)),
        lambda part: S.slopes_blocked(L.stint_windows_blocked(part, scale), scale),
        scale,
    )


@dataclass(frozen=True)
class Scored:
    events: DataFrame
    baselines: DataFrame


def score_laps(laps: DataFrame, rules: Rules = RULES, scale: Scale = SCALE) -> Scored:
    """Laps to risk-scored events for all races at once.

    The windows run twice: once on the few columns the statistics need, once on full rows. The
    statistics are written in between, so full rows only meet counted lookup tables.
    """
    table = stint_table(laps, rules, scale)
    base, field = B.lap_statistics(table)
    events = B.add_field_statistics(table, field, scale)
    events = add_risk_score(B.attach_baselines(events, base, rules, scale), rules)
    return Scored(events, base)


def score_features(features: DataFrame, rules: Rules = RULES, scale: Scale = SCALE) -> Scored:
    """The same from a stored lap-feature table, which already holds the field median."""
    table = S.add_degradation_slopes(laid_by_driver(features, scale), scale)
    base, field = B.lap_statistics(table)
    field = field.drop("field_median_lap_time")
    events = B.versus_field(lookup(table, field, FIELD_KEYS, scale=scale))
    events = add_risk_score(B.attach_baselines(events, base, rules, scale), rules)
    return Scored(events, base)


@dataclass(frozen=True)
class Layout:
    """Where the batch job keeps its tables."""

    raw: str
    raw_single: str
    features: str
    baselines: str
    events: str
    model: str

    @classmethod
    def under(cls, root: str) -> Layout:
        return cls(
            raw=f"{root}/raw/laps",
            raw_single=f"{root}/raw/laps.parquet",
            features=f"{root}/processed/lap_features",
            baselines=f"{root}/processed/baselines",
            events=f"{root}/processed/replay_events",
            model=f"{root}/models/forest",
        )

    def views(self) -> dict[str, str]:
        return {
            "lap_features": self.features,
            "baselines": self.baselines,
            "replay_events": self.events,
        }


def write_features(
    spark: SparkSession, at: Layout, rules: Rules = RULES, scale: Scale = SCALE
) -> DataFrame:
    """Raw laps to the lap-feature table."""
    laps = spark.read.parquet(resolve_laps(spark, at.raw, at.raw_single))
    # The folder value repeats race_round, which the laps carry themselves.
    laps = laps.drop("round")
    write_table(build_ordered(laps, rules, scale), at.features, by=["year"])
    return spark.read.parquet(at.features)


def build_ordered(laps: DataFrame, rules: Rules, scale: Scale) -> DataFrame:
    features = L.build_lap_features(laps, rules, scale)
    return features.select(*laps.columns, *[c for c in features.columns if c not in laps.columns])


def write_model(
    spark: SparkSession, at: Layout, rules: Rules = RULES, scale: Scale = SCALE
) -> M.Forest:
    """Train the anomaly model on the lap-feature table and keep it."""
    training = M.training_frame(spark.read.parquet(at.features))
    forest = M.fit_forest(training, rules=rules, scale=scale)
    forest.save(at.model)
    return forest


def write_events(
    spark: SparkSession,
    at: Layout,
    race: str | None = None,
    rules: Rules = RULES,
    scale: Scale = SCALE,
) -> DataFrame:
    """Baselines and scored replay events, for all races or for one.

    Baselines always come from all races. The anomaly model is used if there is one.
    """
    scored = score_features(spark.read.parquet(at.features), rules, scale)
    write_table(scored.baselines, at.baselines)
    events = scored.events if race is None else scored.events.filter(race_is(race))
    events = M.score_events(events, M.load_forest(spark, at.model))
    write_table(events, at.events, by=["year"])
    written = spark.read.parquet(at.events)
    if written.isEmpty():
        log.warning("no replay events for %s", race or "any race")
    return written


def run_batch(
    spark: SparkSession, at: Layout, race: str | None = None, rules: Rules = RULES
) -> DataFrame:
    """Features, then the model, then events: later steps read what earlier ones wrote."""
    with staging(spark):
        write_features(spark, at, rules)
        try:
            write_model(spark, at, rules)
        except M.TooFewRows as e:
            log.warning("no new anomaly model: %s", e)
        return write_events(spark, at, race, rules)
