"""The live monitor: a stream of events to driver state, history and alerts.

The run of HIGH laps per driver is operator state inside Spark's checkpoint (lap_order). Tables are a
compacted log (live_log): readers see one version, a repeated batch changes nothing, and what has to be
read stays small however long the stream runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stintlab.config import RULES, Rules
from stintlab.operators import live
from stintlab.schemas import LIVE_KEYS
from stintlab.sources.replay import decode_messages
from stintlab.sources.tables import free_shuffles
from stintlab.streaming.lap_order import timed, track_runs
from stintlab.streaming.live_log import Fold, LiveLog, Version

_ORDER = "lap_number"
# What the tables and the order of laps are made of; no other field of a message is read, sent or kept.
_READ = [*LIVE_KEYS, _ORDER, "event_time", "clean_lap", *live.STATE_FIELDS.values(), *live.HISTORY_FIELDS]
# Seconds between two times at which the shuffles of earlier batches are let go.
_FREE_EVERY_S = 15.0
_METRICS = "rows bigint, alerts bigint, batch_id bigint"


def deduplicated(events: DataFrame) -> DataFrame:
    """Optional guard: drop repeats of one lap that arrive within the lateness of `timed` events."""
    return events.dropDuplicatesWithinWatermark([*LIVE_KEYS, _ORDER])


def _newest(rows: DataFrame) -> DataFrame:
    fields = [c for c in rows.columns if c not in ("year", "race_round")]
    first = ["batch_id", _ORDER]
    rest = [c for c in fields if c not in first]
    key = F.struct(*first, *rest)
    best = rows.groupBy(*LIVE_KEYS).agg(F.max(key).alias("_best"))
    return best.select(
        "year", "race_round", *[F.col("_best").getField(c).alias(c) for c in fields]
    ).select(*rows.columns)


def _last_of_each_race(size: int) -> Fold:
    """The newest alerts of each race; a merge of such tables is one again."""
    order = [F.desc(c) for c in ("batch_id", "lap", "driver_code")] + [F.col("reason")]
    place = F.row_number().over(Window.partitionBy("year", "race_round").orderBy(*order))

    def fold(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_place", place).filter(F.col("_place") <= size).drop("_place")

    return fold


def _newest_batch(rows: DataFrame) -> DataFrame:
    best = rows.agg(F.max(F.struct("batch_id", *[c for c in rows.columns if c != "batch_id"])).alias("_best"))
    return best.filter("_best IS NOT NULL").select("_best.*").select(*rows.columns)


def folds(rules: Rules = RULES) -> dict[str, Fold]:
    """How the rows of each table combine; each can be applied to its own results again."""
    return {
        "state": _newest,
        "history": lambda rows: rows.distinct(),
        "alerts": _last_of_each_race(rules.alert_log_size),
        "race": _newest_batch,
        "metrics": lambda rows: rows.coalesce(1),
    }


@dataclass(frozen=True)
class LiveTables:
    """Where the monitor keeps its tables, and how to read them.

    Every reader takes the newest version; `at` fixes one, so that several tables are read as of one batch.
    None before the first batch.
    """

    spark: SparkSession
    root: str
    version: Version | None = None
    rules: Rules = RULES

    @property
    def log(self) -> LiveLog:
        return LiveLog(self.spark, self.root)

    def at(self) -> LiveTables:
        return LiveTables(self.spark, self.root, self.log.newest(), self.rules)

    def _rows(self, table: str) -> DataFrame | None:
        version = self.version or self.log.newest()
        rows = None if version is None else self.log.read(table, version)
        return None if rows is None else folds(self.rules)[table](rows)

    def state(self) -> DataFrame | None:
        """Newest state row per driver and race."""
        rows = self._rows("state")
        return None if rows is None else rows.drop("batch_id")

    def history(self) -> DataFrame | None:
        return self._rows("history")

    def alerts(self) -> DataFrame | None:
        """The last alerts of each race."""
        return self._rows("alerts")

    def alert_log(self, size: int | None = None) -> DataFrame | None:
        """The last alerts of all races."""
        size = self.rules.alert_log_size if size is None else size
        if size > self.rules.alert_log_size:
            raise ValueError(f"only the last {self.rules.alert_log_size} alerts of a race are kept")
        rows = self._rows("alerts")
        return None if rows is None else live.newest_first(rows, size, ["batch_id"])

    def race(self) -> DataFrame | None:
        return self._rows("race")

    def metrics(self) -> DataFrame | None:
        return self._rows("metrics")


def write_batch(
    batch: DataFrame, batch_id: int, tables: LiveTables, rules: Rules = RULES, now: Column | None = None
) -> None:
    """Sinks of one micro-batch; an empty one, or one committed before, does nothing. now is the time of the update.

    The rows and alerts of the batch are counted while they are written.
    """
    log = tables.log
    if log.has(batch_id):
        return
    spark, written = batch.sparkSession, {}
    free_shuffles(spark, _FREE_EVERY_S, wait_s=0)
    now = F.current_timestamp() if now is None else now

    def put(df: DataFrame, table: str) -> None:
        written[table] = (log.put(df, table, batch_id), df._jdf.schema().toDDL())

    rows, alerts = Observation(), Observation()
    batch = batch.persist()
    try:
        put(live.history(batch.observe(rows, F.count(F.lit(1)).alias("n"))), "history")
        if not rows.get["n"]:
            return
        number = F.lit(batch_id).cast("bigint")
        state = live.driver_state(batch).withColumn("timestamp", now)
        put(state.withColumn("batch_id", number), "state")
        alert_rows = live.alerts(batch, rules).withColumns({"timestamp": now, "batch_id": number})
        counted = alert_rows.observe(alerts, F.count(F.lit(1)).alias("n"))
        put(_last_of_each_race(rules.alert_log_size)(counted), "alerts")
        put(live.race_pointer(batch).withColumns({"updated_at": now, "batch_id": number}), "race")
        facts = [(rows.get["n"], alerts.get["n"], batch_id)]
        put(spark.createDataFrame(facts, _METRICS).coalesce(1), "metrics")
        log.commit(batch_id, written, folds(rules))
    finally:
        batch.unpersist()


def start_monitor(
    messages: DataFrame,
    tables: LiveTables,
    checkpoint: str,
    rules: Rules = RULES,
    drain: bool = False,
    dedup_delay: str | None = None,
    idle: str | None = None,
    now: Column | None = None,
    lateness: str = "30 minutes",
) -> StreamingQuery:
    """Start the monitor on any stream of messages; drain stops once the input is used up.

    Laps that arrive out of order within lateness (of event time) are counted in lap order; what waits for
    a missing lap when the input ends stays in the checkpoint until the watermark moves on, by later events
    or by a heartbeat. dedup_delay, if given, is the lateness and turns the duplicate guard on.
    """
    events = timed(decode_messages(messages, _READ), dedup_delay or lateness).drop("event_time")
    if dedup_delay:
        events = deduplicated(events)
    counted = track_runs(events, idle)
    writer = (
        counted.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, tables, rules, now))
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()
