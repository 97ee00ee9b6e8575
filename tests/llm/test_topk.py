import math

from pyspark.sql import functions as F

from stintlab.llm import topk


def plainly(vectors, k=5):
    ok = {i: [math.floor(256 * x) for x in v] for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in (i for i in ok if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(ok[q], v)), i) for i, v in ok.items() if i != q)
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


def search(spark, vectors, k=5):
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    return {tuple(r) for r in topk.exact_top_k(table, F.col("vec_id") % 50 == 0, k).collect()}


def test_equals_all_products_with_ties(spark, rng, monkeypatch):
    vectors = [(i, [rng.choice([0.0, 0.5, -0.25, 1.0]) for _ in range(8)]) for i in range(-60, 700)]
    vectors += [(1000 + i, [0.5] * 8) for i in range(120)]
    assert search(spark, vectors) == plainly(vectors)
    monkeypatch.setattr(topk, "CANDIDATES", 100)
    monkeypatch.setattr(topk, "QUERIES", 3)
    assert search(spark, vectors) == plainly(vectors)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 2.0]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, [None, 1.0]), (4, None), (5, [3.0, -1.0]), (50, [0.0, 0.0]), (None, [9.0, 9.0]), (6, [])]
    assert search(spark, vectors) == plainly(vectors)


def test_few_candidates_large_values_and_empty_table(spark):
    assert search(spark, [(0, [1.0])]) == set()
    large = [(0, [2e5, 1.0]), (1, [1e5, 0.0]), (2, [1e5, 0.0]), (3, [-1e5, 5.0])]
    assert search(spark, large) == plainly(large)
    assert search(spark, []) == set()


def test_rows_with_one_id_are_one_vector(spark):
    vectors = [(0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [3.0])]
    assert search(spark, vectors) == {(0, 1, 2, 256 * 768), (0, 2, 1, 256 * 512)}
