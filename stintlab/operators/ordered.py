"""Ordered windows that stay balanced when one group holds much of the data.

A plain window puts each group in one task. Here the few groups that are too large for that are
found by counting, ranked through a range shuffle, and cut by rank into blocks of equal size.
Running values then carry one number per block, and bounded frames borrow the few rows before
each block. Results are the same as those of the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlab.config import SCALE, Scale
from stintlab.operators.joins import all_of, sized
from stintlab.schemas import LIVE_KEYS, STINT_KEYS
from stintlab.sources.tables import source_bytes, stage

Frames = dict[str, tuple[Column, int, int]]


def same_keys(keys: list[str], prefix: str) -> Column:
    return all_of([F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def hot_groups(df: DataFrame, keys: list[str], scale: Scale = SCALE) -> DataFrame | None:
    """Keys of all oversized groups as a written table, or None if there are none.

    There are at most rows / hot_rows of them, and none is left off.
    """
    if source_bytes(df.select(*keys)) <= scale.small_bytes:
        return None
    counted = df.groupBy(*keys).count().filter(F.col("count") > scale.hot_rows).select(*keys)
    found = stage(counted)
    return None if found.isEmpty() else found


def split_hot(
    df: DataFrame,
    keys: list[str],
    scale: Scale = SCALE,
    coarse: list[str] | None = None,
    counted: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary groups, and rows of oversized groups if there are any.

    coarse is a part of the keys that is cheaper to count: where its groups all are small, finer
    ones are too. counted is a cheaper table with the same rows, if df is costly to derive.
    """
    counted = df if counted is None else counted
    if coarse and hot_groups(counted, coarse, scale) is None:
        return df, None
    hot = hot_groups(counted, keys, scale)
    if hot is None:
        return df, None
    hot = sized(hot, scale).withColumnsRenamed({k: "_hot_" + k for k in keys})
    match = same_keys(keys, "_hot_")
    return df.join(hot, match, "left_anti"), df.join(hot, match, "left_semi")


def per_group(
    df: DataFrame,
    keys: list[str],
    plain: Callable[[DataFrame], DataFrame],
    blocked: Callable[[DataFrame], DataFrame],
    scale: Scale = SCALE,
    coarse: list[str] | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Apply the plain form to ordinary groups and the blocked form to oversized ones."""
    ordinary, hot = split_hot(df, keys, scale, coarse, counted)
    if hot is None:
        return plain(df)
    return plain(ordinary).unionByName(blocked(hot))


def laid_by_driver(df: DataFrame, scale: Scale = SCALE, counted: DataFrame | None = None) -> DataFrame:
    """Rows shuffled once, so that all of a driver's race is in one partition, where no race is oversized.

    Windows and aggregates by stint and by driver then need no further shuffle, as hash partitioning on
    some of their keys is enough for them. Where a race is oversized, rows stay and each window lays
    them out by its own, finer keys.
    """
    if hot_groups(df if counted is None else counted, LIVE_KEYS, scale) is None:
        return df.repartition(*LIVE_KEYS)
    return df


def per_stint(
    df: DataFrame,
    plain: Callable[[DataFrame], DataFrame],
    blocked: Callable[[DataFrame], DataFrame],
    scale: Scale = SCALE,
) -> DataFrame:
    """per_group on stints; a stint is part of one driver's race, which is counted first."""
    return per_group(df, STINT_KEYS, plain, blocked, scale, coarse=LIVE_KEYS)


def ranked(
    df: DataFrame, keys: list[str], order: list[str], name: str, scale: Scale = SCALE
) -> DataFrame:
    """row_number per group as bigint."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return per_group(
        df,
        keys,
        lambda part: part.withColumn(name, F.row_number().over(w).cast("bigint")),
        lambda part: spread_rank(part, keys, order, name, scale),
        scale,
    )


def spread_rank(
    df: DataFrame, keys: list[str], order: list[str], name: str, scale: Scale = SCALE
) -> DataFrame:
    """row_number per group without gathering any group.

    Rows get a written id first, so copies of one row can be told apart and spread too. The range
    shuffle orders all rows; a position inside its partition plus the rows of the same group in
    earlier partitions is the rank. Both steps are written, so retries see the same ids.
    """
    tagged = stage(df.withColumn("_row", F.monotonically_increasing_id()))
    pieces = max(1, math.ceil(tagged.count() / scale.block_rows))
    line = [*keys, *order, "_row"]
    laid = stage(
        tagged.repartitionByRange(pieces, *line)
        .sortWithinPartitions(*line)
        .withColumn("_position", F.monotonically_increasing_id())
        .withColumn("_piece", F.spark_partition_id())
    )
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        laid.groupBy(*keys, "_piece")
        .agg(F.count("*").alias("_rows"), F.min("_position").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .select(
            *[F.col(k).alias("_start_" + k) for k in keys],
            F.col("_piece").alias("_start_piece"),
            "_first",
            "_before",
        )
    )
    match = same_keys(keys, "_start_") & (F.col("_piece") == F.col("_start_piece"))
    rank = F.col("_before") + F.col("_position") - F.col("_first") + 1
    return laid.join(starts, match).select(*df.columns, rank.cast("bigint").alias(name))


def block_of(rank: str, rows: int) -> Column:
    return F.floor((F.col(rank) - 1) / rows).cast("bigint")


def _last_known(value: Column) -> Column:
    return F.last(value, ignorenulls=True)


# Kinds of running value: its aggregate over a frame, and how what is carried joins what is local.
_KINDS = {
    "sum": (F.sum, lambda carry, local: F.coalesce(carry + local, carry, local)),
    "max": (F.max, F.greatest),
    "xor": (F.bit_xor, lambda carry, local: F.coalesce(carry.bitwiseXOR(local), carry, local)),
    "last": (_last_known, lambda carry, local: F.coalesce(local, carry)),
}


def blocked_running(
    df: DataFrame,
    keys: list[str],
    rank: str,
    values: dict[str, tuple[str, Column]],
    scale: Scale = SCALE,
    upto: int = 0,
) -> DataFrame:
    """Running sum, max, xor or last known value from the start of the group, block by block.

    It runs to the row itself, or with upto=-1 to the one before.
    """
    cut = df.withColumn("_block", block_of(rank, scale.block_rows))
    for name, (_, value) in values.items():
        cut = cut.withColumn("_in_" + name, value)

    def whole_block(name: str, kind: str) -> Column:
        value = F.col("_in_" + name)
        if kind != "last":
            return _KINDS[kind][0](value)
        # Rows of a block come in any order here, so the rank tells which is last.
        return F.max(F.when(value.isNotNull(), F.struct(F.col(rank).alias("at"), value.alias("value"))))["value"]

    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys, "_block").agg(
        *[whole_block(name, kind).alias("_all_" + name) for name, (kind, _) in values.items()]
    )
    carried = totals.select(
        *[F.col(k).alias("_total_" + k) for k in keys],
        F.col("_block").alias("_total_block"),
        *[
            _KINDS[kind][0](F.col("_all_" + name)).over(earlier).alias("_from_" + name)
            for name, (kind, _) in values.items()
        ],
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(rank).rowsBetween(Window.unboundedPreceding, upto)
    out = cut.join(carried, same_keys(keys, "_total_") & (F.col("_block") == F.col("_total_block")))
    for name, (kind, _) in values.items():
        reduce, joined = _KINDS[kind]
        out = out.withColumn(name, joined(F.col("_from_" + name), reduce(F.col("_in_" + name)).over(inside)))
    return out.select(*df.columns, *values)


def framed(df: DataFrame, keys: list[str], order: list[str], frames: Frames) -> DataFrame:
    """Aggregates over bounded row frames, one task per group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns(
        {name: agg.over(w.rowsBetween(low, high)) for name, (agg, low, high) in frames.items()}
    )


def blocked_framed(
    df: DataFrame, keys: list[str], rank: str, frames: Frames, scale: Scale = SCALE
) -> DataFrame:
    """The same aggregates with each group cut by rank.

    The last rows of a block are also sent to the next one, where they only serve as history.
    """
    reach = max(-low for _, low, _ in frames.values())
    rows = max(scale.block_rows, reach)
    block = block_of(rank, rows)
    near_end = (F.col(rank) - 1) % rows >= rows - reach
    homes = F.when(near_end, F.array(block, block + 1)).otherwise(F.array(block))
    spread = df.withColumn("_home", block).withColumn("_block", F.explode(homes))
    out = framed(spread, [*keys, "_block"], [rank], frames)
    return out.filter(F.col("_block") == F.col("_home")).drop("_block", "_home")
