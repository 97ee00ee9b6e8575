"""Risk score and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlab.config import RULES, Rules
from stintlab.functions import columns as C


def add_risk_score(
    df: DataFrame, rules: Rules = RULES, null_component: str = "full"
) -> DataFrame:
    """Three components in [0, 1], their weighted sum, and a status.

    The field component sets the distance to the field median against the spread of the field's
    pace delta. A component whose input is unknown counts as 1 wherever a spread is known; pass
    null_component="zero" to count it as 0 instead.
    """
    inputs = {
        "pace_component": ("compound_baseline_delta", "baseline_std_pace_delta", rules.weight_pace),
        "slope_component": (
            "compound_baseline_slope", "baseline_std_degradation_slope", rules.weight_slope,
        ),
        "field_component": ("field_delta", "field_std_pace_delta", rules.weight_field),
    }
    components = {}
    for name, (value, spread, _) in inputs.items():
        component = C.unit_z(F.col(value), F.col(spread))
        if null_component == "zero":
            component = F.when(F.col(value).isNull(), F.lit(0.0)).otherwise(component)
        components[name] = component
    out = df.withColumns(components)
    weighted = sum(F.lit(weight) * F.col(name) for name, (_, _, weight) in inputs.items())
    out = out.withColumn("risk_score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), weighted)))
    return out.withColumn("risk_status", status_of(F.col("risk_score"), rules))


def status_of(score: Column, rules: Rules = RULES) -> Column:
    """Name of the highest level the score reaches; stints too short for one are set apart."""
    level = F.coalesce(
        *[F.when(score >= least, F.lit(name)) for name, least in rules.risk_levels],
        F.lit(rules.lowest_level),
    )
    short = F.coalesce(F.col("clean_laps_in_stint_so_far") < rules.min_clean_laps, F.lit(False))
    return F.when(short, F.lit(rules.too_short)).otherwise(level)
