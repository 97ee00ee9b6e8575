import importlib

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from stintlab.llm import queries

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert difference(spark, connect(DATA), DATA, name) is None


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_else_imports_this_part():
    from pathlib import Path

    root = Path(importlib.import_module("stintlab").__file__).parent
    for path in root.rglob("*.py"):
        assert path.parent.name == "llm" or "stintlab.llm" not in path.read_text()


def test_decontamination_matches_brute_force(spark):
    """Documents with most of an item's five-word runs are exactly those found."""
    words = lambda t: (t or "").lower().split()
    runs = lambda t: {tuple(words(t)[i : i + 5]) for i in range(len(words(t)) - 4)}
    items = [(r["item_id"], runs(r["text"])) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    want = set()
    for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect():
        own = runs(r["text"])
        want |= {(r["doc_id"], i) for i, g in items if len(g & own) > 0.5 * len(g)}
    got = {(r["doc_id"], r["item_id"]) for r in entry.queries()["op9_decontaminate"](spark, DATA).collect()}
    assert got == want and want
