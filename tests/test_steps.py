"""Queries over written tables write what they read and no more."""

import pytest

from stintlab.plans import catalog
from stintlab.sources.tables import path_exists


@pytest.fixture(scope="module")
def few(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("few"))
    spark.range(400).selectExpr(
        "id AS event_id",
        "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, id) AS ts",
        "id % 25 AS user_id",
        "if(id % 5 = 0, 'view', 'click') AS event_type",
        "cast(id % 90 AS double) AS value",
        "concat('{\"k\": ', id % 50, '}') AS props",
    ).write.parquet(f"{root}/events.parquet")
    return root


def written(spark, few):
    at = catalog._layout(spark, few)
    return [n for n in ("raw", "features", "model", "baselines", "events") if path_exists(spark, getattr(at, n))]


def test_each_query_waits_for_its_own_tables(spark, few):
    assert catalog.QUERIES["saved_forest_scores"](spark, few).count() == 400
    assert written(spark, few) == ["model"]
    assert catalog.QUERIES["stored_races"](spark, few).count() == 2
    assert catalog.QUERIES["stored_inventory"](spark, few).first()["laps"] == 400
    assert written(spark, few) == ["raw", "model"]
    assert catalog.QUERIES["report_compound_temp"](spark, few).count() > 0
    assert written(spark, few) == ["raw", "features", "model"]
    assert catalog.QUERIES["stored_events"](spark, few).count() == 400
    assert written(spark, few) == ["raw", "features", "model", "baselines", "events"]
