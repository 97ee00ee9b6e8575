"""Waiting laps are kept many to an entry, and a replay of many races keeps a driver's laps together."""

import pytest
from pyspark.sql import functions as F

from stintlab.sources import replay
from stintlab.streaming import lap_order
from tests.test_lap_order import Driver


def test_a_batch_that_waits_is_one_entry():
    driver = Driver()
    driver.send([(n, 1000, True, str(n)) for n in range(2, 60)])
    assert len(driver.step.waiting) == 1 and not driver.out
    driver.send([(1, 1000, True, "1")])
    assert driver.out == [(str(n), n) for n in range(1, 60)] and not driver.step.waiting


@pytest.mark.parametrize("size", [1, 2, 3, 256])
def test_entries_of_any_size_keep_the_order_of_arrival(monkeypatch, size):
    monkeypatch.setattr(lap_order, "_ENTRY_LAPS", size)
    driver = Driver()
    driver.send([(5, 1000, True, "5a"), (3, 1000, True, "3a"), (3, 1000, False, "3b"), (7, 9000, True, "7")])
    driver.send([(5, 1000, True, "5b"), (3, 1000, True, "3c"), (2, 1000, True, "2")])
    assert not driver.out
    driver.send([(1, 1000, True, "1")])
    assert driver.out == [("1", 1), ("2", 2), ("3a", 3), ("3b", 0), ("3c", 1)]
    driver.watermark(1000)
    assert driver.out[5:] == [("5a", 2), ("5b", 3)]
    driver.watermark(9000)
    assert driver.out[7:] == [("7", 4)] and not driver.step.waiting


def test_a_drivers_messages_are_in_one_file(spark, tmp_path):
    laps = spark.range(2000).selectExpr(
        "2024 AS year", "cast(id % 4 AS int) AS race_round", "concat('D', id % 40) AS driver_code", "id DIV 40 + 1 AS lap_number"
    )
    replay.publish_race_files(laps.repartition(8), str(tmp_path / "m"), "2024-01-01T00:00:00+00:00", "2024-01-02T00:00:00+00:00")
    sent = spark.read.parquet(str(tmp_path / "m")).withColumn("file", F.col("_metadata.file_name"))
    assert sent.count() == 2001 and sent.filter("key = ''").count() == 1
    assert sent.groupBy("key").agg(F.countDistinct("file").alias("n")).filter("n > 1").isEmpty()
