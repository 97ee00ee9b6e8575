"""Weather as of each lap start."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stintlab.config import SCALE, Scale
from stintlab.operators.joins import all_of, sized
from stintlab.operators.ordered import blocked_running, per_group, spread_rank
from stintlab.schemas import WEATHER_DDL, WEATHER_NAMES, names_of, struct_of
from stintlab.sources.tables import source_bytes, stage

SESSION = ["year", "race_round"]
MEASURES = names_of(WEATHER_DDL)

# Starting bucket width, and how many samples the densest bucket should hold at most.
_BUCKET_SECONDS = 60.0
_SAMPLES_PER_BUCKET = 16


def project_weather(raw: DataFrame, keys: list[str] = SESSION, time: str = "t_sec") -> DataFrame:
    """Raw weather columns to lap-table names and declared types.

    A measure the source lacks, or has only as untyped nulls, comes out as a typed null, so
    sessions without weather can share one table with the others.
    """
    types = {f.name: f.dataType for f in struct_of(WEATHER_DDL)}
    measures = []
    for source, target in WEATHER_NAMES.items():
        value = F.col(source) if source in raw.columns else F.lit(None)
        measures.append(value.try_cast(types[target]).alias(target))
    return raw.select(*keys, F.col(time).try_cast("double").alias("t_sec"), *measures)


def without_weather(laps: DataFrame) -> DataFrame:
    """Laps of sessions that have no weather: the same columns, all null, with their types."""
    return laps.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in struct_of(WEATHER_DDL)}
    )


def bucket_width(samples: DataFrame, scale: Scale) -> float:
    """Bucket width, narrowed for large tables until the bucket with most instants is small."""
    if source_bytes(samples) <= scale.small_bytes:
        return _BUCKET_SECONDS
    bucket = F.floor(F.col("t_sec") / _BUCKET_SECONDS)
    densest = samples.groupBy(*SESSION, bucket).count().agg(F.max("count")).first()[0] or 1
    return _BUCKET_SECONDS / 2 ** math.ceil(math.log2(max(1, densest / _SAMPLES_PER_BUCKET)))


def _carry_plain(buckets: DataFrame) -> DataFrame:
    before = Window.partitionBy(*SESSION).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return buckets.withColumn("measures", F.last("newest", ignorenulls=True).over(before))


def _carry_blocked(buckets: DataFrame, scale: Scale) -> DataFrame:
    placed = spread_rank(buckets, SESSION, ["bucket"], "_place", scale)
    newest = {"measures": ("last", F.col("newest"))}
    return blocked_running(placed, SESSION, "_place", newest, scale, upto=-1).drop("_place")


def carried_measures(buckets: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """The last sample of a session before each of its buckets.

    A session with very many buckets is cut into blocks that take over one sample each, so no task
    has to see all of it.
    """
    if source_bytes(buckets) > scale.small_bytes:
        buckets = stage(buckets)
    return per_group(buckets, SESSION, _carry_plain, lambda hot: _carry_blocked(hot, scale), scale)


def weather_spans(laps: DataFrame, samples: DataFrame, width: float, scale: Scale = SCALE) -> DataFrame:
    """Each sample with the time range it is current for, cut at bucket borders.

    Buckets are those that hold a sample or a lap. A bucket starts with the last sample of the
    buckets before it. Ranges within a bucket do not overlap, so a lap meets one at most.
    """
    bucket = F.floor(F.col("t_sec") / width)
    points = samples.select(*SESSION, bucket.alias("bucket"), "t_sec", "measures")
    wanted = laps.select(*SESSION, F.floor(F.col("lap_start_time_sec") / width).alias("bucket"))
    wanted = wanted.filter(F.col("bucket").isNotNull()).distinct()
    empty = F.lit(None)
    buckets = (
        points.unionByName(
            wanted.withColumns(
                {
                    "t_sec": empty.cast("double"),
                    "measures": empty.cast(points.schema["measures"].dataType),
                }
            )
        )
        .groupBy(*SESSION, "bucket")
        .agg(F.max_by("measures", "t_sec").alias("newest"), F.min("t_sec").alias("first_sec"))
    )
    carried = carried_measures(buckets, scale).select(
        *SESSION,
        "bucket",
        F.lit(float("-inf")).alias("from_sec"),
        F.coalesce(F.col("first_sec"), F.lit(float("inf"))).alias("to_sec"),
        "measures",
    ).filter(F.col("measures").isNotNull())
    next_sec = F.lead("t_sec").over(Window.partitionBy(*SESSION, "bucket").orderBy("t_sec"))
    own = points.select(
        *SESSION,
        "bucket",
        F.col("t_sec").alias("from_sec"),
        F.coalesce(next_sec, F.lit(float("inf"))).alias("to_sec"),
        "measures",
    )
    return own.unionByName(carried)


def attach_weather(laps: DataFrame, weather: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """Newest sample of the session at or before the lap start; null measures where there is none.

    Laps are neither sorted nor gathered by session: spans of the (small) weather table are
    equi-joined on session and time bucket, by broadcast when the counted size allows it, else by
    a shuffle on those keys. Samples at one instant collapse to one before anything else.
    """
    samples = (
        weather.filter(F.col("t_sec").isNotNull())
        .groupBy(*SESSION, "t_sec")
        .agg(F.max(F.struct(*MEASURES)).alias("measures"))
    )
    width = bucket_width(samples.select(*SESSION, "t_sec"), scale)
    spans = sized(weather_spans(laps, samples, width, scale), scale).select(
        *[F.col(k).alias("_w_" + k) for k in SESSION],
        F.col("bucket").alias("_w_bucket"),
        F.col("from_sec").alias("_w_from"),
        F.col("to_sec").alias("_w_to"),
        F.col("measures").alias("_w_measures"),
    )
    start = F.col("lap_start_time_sec")
    current = all_of(
        [F.col(k) == F.col("_w_" + k) for k in SESSION]
        + [F.floor(start / width) == F.col("_w_bucket")]
        + [start >= F.col("_w_from"), start < F.col("_w_to")]
    )
    return laps.join(spans, current, "left").select(
        *laps.columns, *[F.col(f"_w_measures.{m}").alias(m) for m in MEASURES]
    )
