"""Exact quantiles of a column, and exact medians of groups, of any size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlab.config import SCALE, Scale
from stintlab.operators.joins import all_of, sized
from stintlab.sources.tables import stage, stage_counted

# A quantile sketch is off in rank by at most one part in so many. Below half as many values it drops
# none; half of that again is taken as the number it is trusted with.
SKETCH = 40_000


def exact_quantiles(
    df: DataFrame, name: str, points: list[float], scale: Scale = SCALE
) -> list[float | None]:
    """Quantiles with linear interpolation between the two nearest values; None without any value.

    Equal values become one row with a count. The rows are laid out in order by a range shuffle
    into pieces of bounded size; counts per piece tell which pieces hold the wanted ranks, and only
    those are ranked row by row. Results do not depend on the number of pieces.
    """
    counted = stage(
        df.select(F.col(name).cast("double").alias("value")).filter("value IS NOT NULL")
        .groupBy("value").agg(F.count("*").alias("times"))
    )
    pieces = max(1, math.ceil(counted.count() / scale.block_rows))
    laid = stage(
        counted.repartitionByRange(pieces, "value").withColumn("piece", F.spark_partition_id())
    )
    sizes = laid.groupBy("piece").agg(F.sum("times").alias("rows")).orderBy("piece").collect()
    total = sum(r["rows"] for r in sizes)
    if not total:
        return [None] * len(points)
    before, starts = 0, {}
    for r in sizes:
        starts[r["piece"]] = before
        before += r["rows"]
    ranks = sorted({r for p in points for r in (math.floor(p * (total - 1)), math.ceil(p * (total - 1)))})
    holding = [max((s, p) for p, s in starts.items() if s <= rank)[1] for rank in ranks]
    wanted = df.sparkSession.createDataFrame(
        [(p, rank - starts[p], rank) for p, rank in zip(holding, ranks)], "piece int, place long, rank long"
    )
    so_far = Window.partitionBy("piece").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    reached = (
        laid.filter(F.col("piece").isin(sorted(set(holding))))
        .withColumn("end", F.sum("times").over(so_far))
        .join(F.broadcast(wanted), "piece")
        .filter((F.col("place") < F.col("end")) & (F.col("place") >= F.col("end") - F.col("times")))
    )
    at = {r["rank"]: r["value"] for r in reached.select("rank", "value").collect()}
    out = []
    for p in points:
        place = p * (total - 1)
        low, high = at[math.floor(place)], at[math.ceil(place)]
        out.append(low + (high - low) * (place - math.floor(place)))
    return out


def grouping_number(group: list[str], keys: list[str]) -> int:
    """What grouping_id says of a grouping: a bit for each key it leaves out."""
    return sum((k not in group) << i for i, k in enumerate(reversed(keys)))


def group_medians(
    rows: DataFrame,
    groups: list[list[str]],
    medians: dict[str, str],
    others: list[Column],
    scale: Scale = SCALE,
    sketch: int = SKETCH,
) -> DataFrame:
    """Aggregates of several groupings in one pass, with exact medians of columns however large a group is.

    medians maps result names to columns. A median is the value at rank ceil(n / 2), an element of the
    data. One sketch per group tells it exactly up to `sketch` / 4 values; for larger groups it gives a range
    that must hold the median, and a second pass over the rows of those groups alone counts the values
    inside and the rows on either side. Counts combine before they are shuffled, so a group with a third
    of all rows costs one task no more than the few values of its range. The number of the grouping is
    in _grouping; the result is written.
    """
    keys = list(dict.fromkeys(k for group in groups for k in group))
    near = [0.5 - 2 / sketch, 0.5, 0.5 + 2 / sketch]
    marks = [F.percentile_approx(c, near, sketch).alias("_near_" + name) for name, c in medians.items()]
    counts = [F.count(c).alias("_n_" + name) for name, c in medians.items()]
    entries = [*others, *marks, *counts, F.grouping_id().alias("_grouping")]
    found, facts = stage_counted(
        rows.groupingSets(groups, *keys).agg(*entries),
        most=F.max(F.greatest(F.lit(0), *["_n_" + name for name in medians])),
    )
    rest = [c for c in found.columns if not c.startswith(("_near_", "_n_"))]

    def middle(name: str) -> Column:
        return F.col("_near_" + name)[1]

    if (facts["most"] or 0) <= sketch // 4:
        return found.select(*rest, *[middle(name).alias(name) for name in medians])
    settled = _settled(rows, found, groups, keys, medians, scale, sketch)
    match = all_of([F.col(k).eqNullSafe(F.col("_at_" + k)) for k in [*keys, "_grouping"]])
    exact = sized(settled.withColumnsRenamed({k: "_at_" + k for k in [*keys, "_grouping"]}), scale)
    return stage(
        found.join(exact, match, "left").select(
            *rest, *[F.coalesce("_exact_" + name, middle(name)).alias(name) for name in medians]
        )
    )


def _settled(
    rows: DataFrame,
    found: DataFrame,
    groups: list[list[str]],
    keys: list[str],
    medians: dict[str, str],
    scale: Scale,
    sketch: int,
) -> DataFrame:
    """Exact medians of the groups too large for the sketch, named by keys and number of the grouping."""
    names = list(medians)
    parts = []
    for group in groups:
        number = grouping_number(group, keys)
        large = found.filter((F.col("_grouping") == number) & (F.greatest(F.lit(0), *["_n_" + n for n in names]) > sketch // 4))
        ranges = large.select(
            *[F.col(k).alias("_in_" + k) for k in group],
            *[F.col("_near_" + n).alias("_range_" + n) for n in names],
        )
        inside = rows.join(sized(ranges, scale), all_of([F.col(k).eqNullSafe(F.col("_in_" + k)) for k in group] or [F.lit(True)]))
        one = [
            F.struct(F.lit(i).alias("which"), F.col(c).cast("double").alias("value"),
                     F.col("_range_" + n)[0].cast("double").alias("low"), F.col("_range_" + n)[2].cast("double").alias("high"))
            for i, (n, c) in enumerate(medians.items())
        ]
        place = {k: F.col(k) if k in group else F.lit(None).cast(rows.schema[k].dataType) for k in keys}
        parts.append(
            inside.select(*[c.alias(k) for k, c in place.items()], F.lit(number).cast("long").alias("_grouping"),
                          F.explode(F.array(*one)).alias("v")).filter("v.value IS NOT NULL")
        )
    pooled = parts[0]
    for part in parts[1:]:
        pooled = pooled.unionByName(part)
    v = F.col("v")
    side = F.when(v["value"] < v["low"], -1).when(v["value"] > v["high"], 1).otherwise(0)
    of = [*keys, "_grouping", "which"]
    counted = (
        pooled.select(*keys, "_grouping", v["which"].alias("which"), side.alias("side"), v["value"].alias("value"))
        .withColumn("value", F.when(F.col("side") == 0, F.col("value")))
        .groupBy(*of, "side", "value").agg(F.count("*").alias("times"))
    )
    whole, line = Window.partitionBy(*of), Window.partitionBy(*of).orderBy("side", "value")
    ranked = counted.withColumns({"total": F.sum("times").over(whole), "end": F.sum("times").over(line)})
    target = F.ceil(F.col("total") / 2)
    at = ranked.filter((F.col("end") >= target) & (F.col("end") - F.col("times") < target))
    # The sketch's bound puts the median inside its range; anything else must not pass unseen.
    value = F.when(F.col("side") == 0, F.col("value")).otherwise(
        F.raise_error(F.lit("a median lies outside the range of its sketch")).cast("double")
    )
    return at.groupBy(*keys, "_grouping").agg(
        *[F.max(F.when(F.col("which") == i, value)).alias("_exact_" + n) for i, n in enumerate(names)]
    )
