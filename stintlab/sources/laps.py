"""Partitioned lap storage: layout, skipping what exists, sweep manifest, inventory."""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlab.schemas import LAP_DDL, WEATHER_DDL, struct_of
from stintlab.sources.tables import matching_paths, path_exists, remove, replace_folder, write_partitioned

PARTITION = ["year", "round"]
RAW_DDL = LAP_DDL.rstrip() + "," + WEATHER_DDL


def partition_path(root: str, year: int, race_round: int) -> str:
    return f"{root}/year={year}/round={race_round}"


def write_raw_laps(laps: DataFrame, root: str) -> None:
    """Write laps under year=/round=, replacing only the races in the input.

    race_round stays a data column; round is its copy in the path. Weather columns are cast to
    their types first, so sessions without weather do not leave untyped columns behind. A value
    that its column's type cannot hold is written as unknown.
    """
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in struct_of(RAW_DDL) if f.name in laps.columns]
    write_partitioned(
        laps.select(*typed, F.col("race_round").cast("int").alias("round")), root, PARTITION
    )


def read_raw_laps(spark: SparkSession, root: str) -> DataFrame:
    """Raw laps of all races; filters on year and round prune whole folders."""
    return spark.read.parquet(root)


def existing_races(spark: SparkSession, root: str) -> DataFrame:
    """(year, race_round) of the races stored under root, as the folders say; no file is opened."""
    found = [re.search(r"year=(-?\d+)/round=(-?\d+)$", p) for p in matching_paths(spark, f"{root}/year=*/round=*")]
    races = [(int(m[1]), int(m[2])) for m in found if m]
    return spark.createDataFrame(races, "year int, race_round int")


def only_new(laps: DataFrame, existing: DataFrame) -> DataFrame:
    """Laps of races not stored yet. The race list is the small side of the anti join."""
    return laps.join(existing.select("year", "race_round"), ["year", "race_round"], "left_anti")


def ingest(laps: DataFrame, root: str, skip_existing: bool = False) -> None:
    if skip_existing:
        laps = only_new(laps, existing_races(laps.sparkSession, root))
    write_raw_laps(laps, root)


def race_rounds(schedule: DataFrame) -> DataFrame:
    """Races to ingest: testing (round 0 or below) dropped, in order."""
    return schedule.filter(F.col("round") > 0).orderBy("year", "round")


def unreadable(laps: DataFrame) -> Column:
    """True for a row with a value that its column's type cannot hold."""
    kinds = [f for f in struct_of(RAW_DDL) if f.name in laps.columns]
    return reduce(
        lambda a, b: a | b,
        [F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in kinds],
        F.lit(False),
    )


def readable_races(laps: DataFrame) -> DataFrame:
    """(year, race_round) of the races all of whose values can be read."""
    keys = [F.col(k).try_cast("int").alias(k) for k in ("year", "race_round")]
    races = laps.select(*keys, unreadable(laps).alias("bad")).groupBy("year", "race_round")
    return races.agg(F.bool_or("bad").alias("bad")).filter(~F.col("bad")).drop("bad")


def sweep_manifest(
    schedule: DataFrame, landed: DataFrame, existing: DataFrame, skip_existing: bool = True
) -> DataFrame:
    """What a sweep does with each scheduled race: written, skipped or failed.

    A race is skipped if stored already, written if its laps have landed, failed otherwise.
    """
    keys = ["year", "race_round"]
    races = race_rounds(schedule).withColumnRenamed("round", "race_round")
    arrived = landed.select(*keys).distinct().withColumn("_landed", F.lit(True))
    stored = existing.select(*keys).distinct().withColumn("_stored", F.lit(True))
    out = races.join(arrived, keys, "left").join(stored, keys, "left")
    skip = F.col("_stored") & F.lit(skip_existing)
    status = F.when(skip, "skipped").when(F.col("_landed"), "written").otherwise("failed")
    return out.withColumn("status", status).drop("_landed", "_stored")


# Folders of a lap store that readers of it skip, as their names say.
_ASIDE, _STATUS = "_aside", "_status"


def _race_is_one_of(races: list[tuple[int, int]]) -> Column:
    """Plain comparisons, so that they reach the scan and whatever was derived from it."""
    by_year: dict[int, list[int]] = {}
    for year, race_round in races:
        by_year.setdefault(year, []).append(race_round)
    year, number = F.col("year").try_cast("int"), F.col("race_round").try_cast("int")
    terms = [(year == y) & number.isin(sorted(r)) for y, r in sorted(by_year.items())]
    return reduce(lambda a, b: a | b, terms, F.lit(False))


def publish_races(laps: DataFrame, races: list[tuple[int, int]], root: str) -> list[tuple[int, int, str, str | None]]:
    """(year, race_round, status, reason) of races written each by itself, though by few jobs.

    All races are checked and written aside in one job each. If that fails, each half is tried on its own,
    so a race that cannot be computed costs some jobs more and fails alone. What was written is published
    race by race, by renaming its folder: readers see a race whole or not at all. races is bounded by the
    calendar.
    """
    if not races:
        return []
    spark = laps.sparkSession
    aside = f"{root}/{_ASIDE}/{uuid.uuid4().hex}"
    part = laps.filter(_race_is_one_of(races))
    try:
        readable = [tuple(r) for r in readable_races(part).collect()]
        write_raw_laps(part.filter(_race_is_one_of(readable)), aside)
    except Exception as e:  # whatever stops a job must not stop the others
        remove(spark, aside)
        if len(races) == 1:
            return [(*races[0], "failed", str(e).splitlines()[0][:500])]
        half = len(races) // 2
        return publish_races(laps, races[:half], root) + publish_races(laps, races[half:], root)
    out = []
    for year, race_round in races:
        source = partition_path(aside, year, race_round)
        if path_exists(spark, source):
            replace_folder(spark, source, partition_path(root, year, race_round))
            out.append((year, race_round, "written", None))
        else:
            out.append((year, race_round, "failed", "a value cannot be read"))
    remove(spark, aside)
    return out


def sweep_status(spark: SparkSession, root: str) -> DataFrame:
    """What sweeps have done so far: run, year, race_round, status and the reason of a failure."""
    schema = "year int, race_round int, status string, reason string, run string"
    if not path_exists(spark, f"{root}/{_STATUS}/run=*"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{_STATUS}")


def sweep(
    schedule: DataFrame, landed: DataFrame, root: str, skip_existing: bool = True
) -> DataFrame:
    """Ingest every scheduled race; returns counts per status, and keeps the status of each race.

    A race without laps, with a value that cannot be read, or whose laps cannot be computed fails by
    itself and does not hold up the others.
    """
    spark = landed.sparkSession
    manifest = sweep_manifest(schedule, landed, existing_races(spark, root), skip_existing).select("year", "race_round", "status")
    # Bounded by the race calendar.
    planned = [tuple(r) for r in manifest.collect()]
    wanted = [r[:2] for r in planned if r[2] == "written"]
    done = {r[:2]: r[2:] for r in publish_races(landed, wanted, root)}
    rows = [(*r[:2], *done.get(r[:2], (r[2], "no laps" if r[2] == "failed" else None))) for r in planned]
    status = spark.createDataFrame(rows, "year int, race_round int, status string, reason string")
    status.coalesce(1).write.parquet(f"{root}/{_STATUS}/run={uuid.uuid4().hex}")
    return status.groupBy("status").agg(F.count("*").alias("count"))


def race_counts(spark: SparkSession, root: str) -> DataFrame:
    """(year, race_round, laps) of every stored race, from file footers alone.

    Counts by folder are pushed into the columnar scan, which then reads no data column. That needs the
    newer reader, so a session of its own is set up for it; the result is one row per race. Ranges are not
    taken this way: the scan finds a column's range by its place, and files of a store may differ in columns.
    """
    schema = "year int, race_round int, laps bigint"
    if not path_exists(spark, f"{root}/year=*/round=*"):
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(_footer_counts(spark, root).collect(), schema)


def _footer_counts(spark: SparkSession, root: str) -> DataFrame:
    aside = spark.newSession()
    aside.conf.set("spark.sql.sources.useV1SourceList", "")
    aside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return aside.read.parquet(root).groupBy("year", "round").agg(F.count("*"))


def stored_by_year(spark: SparkSession, root: str) -> DataFrame:
    """Races and rows per season of the stored laps, as corpus_by_year has them, without reading a lap."""
    return (
        race_counts(spark, root).groupBy("year")
        .agg(F.count("*").alias("races"), F.sum("laps").alias("laps")).orderBy("year")
    )


def corpus_by_year(laps: DataFrame) -> DataFrame:
    """Races and rows per season."""
    return (
        laps.groupBy("year")
        .agg(F.countDistinct("race_round").alias("races"), F.count("*").alias("laps"))
        .orderBy("year")
    )


def resolve_laps(spark: SparkSession, root: str, single: str) -> str:
    """The partitioned folder if it holds races, else the single table, else an error."""
    if path_exists(spark, f"{root}/year=*/round=*"):
        return root
    if path_exists(spark, single):
        return single
    raise FileNotFoundError(f"no lap data under {root} or at {single}")
