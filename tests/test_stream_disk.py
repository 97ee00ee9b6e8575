"""What a stream of many laps leaves on disk: only what is read of a message, and no shuffles of earlier jobs."""

import time

from pyspark.sql import functions as F

from stintlab.operators import live
from stintlab.sources import replay
from stintlab.sources.tables import free_shuffles
from stintlab.streaming.monitor import _READ


def test_only_what_the_tables_need_is_read(spark):
    events = spark.range(1).selectExpr("2024 AS year", "'D1' AS driver_code", "id AS lap_number", "2.5D AS pit_in_time", "90.5D AS lap_time_sec")
    sent = replay.replay_messages(events, event_time="2024-01-01T00:00:00+00:00")
    got = replay.decode_messages(sent, _READ)
    assert set(got.columns) == set(_READ) - {"consecutive_high"}
    assert {*live.STATE_FIELDS.values(), *live.HISTORY_FIELDS} - {"consecutive_high"} <= set(got.columns)
    whole = replay.decode_messages(sent)
    assert got.first() == whole.select(*got.columns).first() and len(whole.columns) > len(got.columns)


def test_shuffles_of_finished_jobs_are_let_go(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {f for f in (found.apply(i).getName() for i in range(found.size())) if f.startswith("shuffle_")}

    before = files()
    spark.range(10000).groupBy(F.col("id") % 100).count().collect()
    made = files() - before
    assert made
    until = time.time() + 60
    while made & files() and time.time() < until:
        free_shuffles(spark)
    assert not made & files()
