"""Lookup joins that broadcast only what has been counted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from stintlab.config import SCALE, Scale
from stintlab.sources.tables import stage_counted


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def sized(table: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """Write a lookup table and mark it for broadcast if it was measured to be small.

    Rows and the bytes of their values, not of compressed files, are counted in the pass that writes.
    Past the limits it is returned unmarked: the join shuffles, and AQE splits skewed partitions.
    """
    lengths = F.lit(0)
    for f in table.schema:
        if f.dataType.typeName() in ("string", "binary"):
            lengths = lengths + F.coalesce(F.octet_length(f.name), F.lit(0))
    table, facts = stage_counted(table, rows=F.count(F.lit(1)), text=F.sum(lengths.cast("bigint")))
    # Numbers take eight bytes at most; structs are counted by their leaves.
    width = 16 + 8 * sum(_leaves(f.dataType) for f in table.schema)
    rows, text = facts["rows"], facts["text"] or 0
    if rows <= scale.broadcast_rows and text + rows * width <= scale.broadcast_bytes:
        return F.broadcast(table)
    return table


def _leaves(kind: DataType) -> int:
    return sum(_leaves(f.dataType) for f in kind) if isinstance(kind, StructType) else 1


def lookup(
    df: DataFrame,
    table: DataFrame,
    keys: list[str],
    null_safe: bool = False,
    scale: Scale = SCALE,
) -> DataFrame:
    """Left join with a table that is unique on keys; its other columns are appended."""
    renamed = {k: f"_key_{k}" for k in keys}
    right = sized(table, scale).withColumnsRenamed(renamed)
    pairs = [
        F.col(k).eqNullSafe(F.col(r)) if null_safe else F.col(k) == F.col(r)
        for k, r in renamed.items()
    ]
    return df.join(right, all_of(pairs), "left").drop(*renamed.values())
