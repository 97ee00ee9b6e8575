"""Every threshold the operators use, in one frozen place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    """Domain rules. Results depend on them being exactly these."""

    first_clean_lap: int = 2
    bad_track_status: str = "4567"
    tyre_age_buckets: tuple[tuple[int, int], ...] = ((0, 5), (6, 10), (11, 15), (16, 20), (21, 999))
    open_ended_age: int = 999

    min_baseline_samples: int = 5
    weight_pace: float = 0.4
    weight_slope: float = 0.4
    weight_field: float = 0.2
    # Levels from the highest down, each from its score on.
    risk_levels: tuple[tuple[str, float], ...] = (("HIGH", 0.70), ("MEDIUM", 0.40))
    lowest_level: str = "LOW"
    too_short: str = "INSUFFICIENT_DATA"
    min_clean_laps: int = 3

    alert_run_length: int = 2
    alert_risk: float = 0.80
    alert_log_size: int = 200
    alert_page_size: int = 50

    trees: int = 200
    contamination: float = 0.05
    forest_seed: int = 42
    tree_sample: int = 256
    min_training_rows: int = 50


@dataclass(frozen=True)
class Scale:
    """When an operator leaves the plain plan. Results never depend on these sizes."""

    # Inputs whose scan is smaller than this cannot hold a group worth splitting.
    small_bytes: int = 64 << 20
    # A window group with more rows than this is cut into blocks.
    hot_rows: int = 2_000_000
    # Rows per block of a cut group.
    block_rows: int = 500_000
    # A lookup table is broadcast only below both of these, measured on its written values.
    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 64 << 20


RULES = Rules()
SCALE = Scale()
