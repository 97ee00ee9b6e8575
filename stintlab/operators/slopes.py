"""Tyre degradation slopes over the last clean laps of a stint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.config import SCALE, Scale
from stintlab.operators.joins import all_of
from stintlab.operators.ordered import Frames, blocked_framed, framed, per_stint
from stintlab.schemas import LAP_ORDER, STINT_KEYS


def _frames() -> Frames:
    x, y = F.col("stint_lap_number").cast("double"), F.col("lap_time_sec")
    return {f"_slope_{laps}": (F.regr_slope(y, x), 1 - laps, 0) for laps in (3, 5)}


def _finish(df: DataFrame) -> DataFrame:
    known = all_of([F.col(k).isNotNull() for k in [*STINT_KEYS, *LAP_ORDER]])
    # On a clean lap the running count is the number of clean laps a frame could reach.
    seen = F.col("clean_laps_in_stint_so_far")
    columns = {
        f"degradation_slope_{laps}": F.when(
            F.col("clean_lap") & known & (seen >= laps), F.col(f"_slope_{laps}")
        )
        for laps in (3, 5)
    }
    return df.withColumns(columns).drop(*_frames())


def slopes_plain(df: DataFrame) -> DataFrame:
    """Clean laps form their own window group, so a frame counts clean laps only.

    The group is finer than the stint: data already laid out by stint is not shuffled again.
    """
    return _finish(framed(df, [*STINT_KEYS, "clean_lap"], LAP_ORDER, _frames()))


def slopes_blocked(df: DataFrame, scale: Scale) -> DataFrame:
    clean = df.filter(F.col("clean_lap"))
    rest = df.filter(~F.coalesce(F.col("clean_lap"), F.lit(False)))
    fitted = _finish(
        blocked_framed(clean, STINT_KEYS, "clean_laps_in_stint_so_far", _frames(), scale)
    )
    return fitted.unionByName(rest, allowMissingColumns=True)


def add_degradation_slopes(df: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """Least-squares slope of lap time on stint lap number over the last 3 and 5 clean laps.

    Null on unclean laps, until enough clean laps are there, and where a stint key is unknown.
    """
    return per_stint(df, slopes_plain, lambda hot: slopes_blocked(hot, scale), scale)
