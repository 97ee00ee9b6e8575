"""Exact top-k by inner product over integer vectors.

Term at a time: a term is a dimension, its postings are the candidates' values there. Candidates
and queries are dealt into groups of bounded size; a task holds one group of each, adds every
query's weighted postings term by term into dense score rows, and keeps k of each row. The partial
lists merge by a ranked window, which Spark limits to k rows per query before its shuffle.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlab.llm.common import ship_package, stage

# Vectors in one group of candidates and of queries: the dense scores of a task hold their product.
CANDIDATES, QUERIES = 4096, 1024
_FOUND = "query_id long, vec_id long, score long"
# Below this, score and place fit one 64-bit number and ties are settled by a partial sort.
_PACKABLE = 1 << 42


def integer_vectors(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id and terms (long array): floor(scale * x) of every component x.

    A null vector, one with a null, NaN or infinite component and a null id take no part. Of rows
    that share an id the one with the smallest vector stays. Other columns are left out.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return (
        vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull()).filter(finite)
        .select("vec_id", F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("terms"))
        .groupBy("vec_id").agg(F.min("terms").alias("terms"))
    )


def _dense(column: pa.Array, width: int) -> np.ndarray:
    """Rows by terms; a vector shorter than the widest has no posting for the rest."""
    lengths = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten(), dtype=np.int64)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _accumulate(queries: np.ndarray, postings: np.ndarray) -> np.ndarray:
    """postings: terms by candidates. Each term's postings go to the rows whose query has it."""
    scores = np.zeros((len(queries), postings.shape[1]), dtype=np.int64)
    for term in range(postings.shape[0]):
        has = np.flatnonzero(queries[:, term])
        places = np.flatnonzero(postings[term])
        if len(has) == len(queries) and len(places) == postings.shape[1]:
            scores += queries[:, term, None] * postings[term]
        elif len(has) and len(places):
            scores[np.ix_(has, places)] += queries[has, term, None] * postings[term, places]
    return scores


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of one query's k best among ids in ascending order, its own row left out."""
    skip = np.searchsorted(ids, own)
    skip = skip if skip < len(ids) and ids[skip] == own else -1
    if abs(scores).max(initial=0) < _PACKABLE:
        packed = scores * (1 << 20) - np.arange(len(ids))
        if skip >= 0:
            packed[skip] = np.iinfo(np.int64).min
        take = min(k + 1, len(ids))
        top = np.argpartition(-packed, take - 1)[:take]
        order = top[np.argsort(-packed[top])]
    else:
        order = np.lexsort((ids, -scores))
    return order[order != skip][:k]


def _search(k: int, scale_rows: int = 128):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("vec_id")
        terms = table["terms"].combine_chunks()
        asks = np.asarray(table["asks"])
        ids = np.asarray(table["vec_id"])
        width = int(max(np.asarray(terms.value_lengths()), default=0))
        vectors = _dense(terms, width)
        queries, query_ids = vectors[asks], ids[asks]
        kept, kept_ids = np.ascontiguousarray(vectors[~asks].T), ids[~asks]
        out: list[tuple] = []
        for at in range(0, len(queries), scale_rows) if len(kept_ids) else []:
            scores = _accumulate(queries[at : at + scale_rows], kept)
            for row, own in zip(scores, query_ids[at : at + scale_rows]):
                out += [(int(own), int(kept_ids[i]), int(row[i])) for i in _best(row, kept_ids, own, k)]
        names = ("query_id", "vec_id", "score")
        return pa.table({n: pa.array([r[i] for r in out], pa.int64()) for i, n in enumerate(names)})

    return run


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of all other vectors for each query.

    Ties go to the smaller vec_id. Fewer than k others give fewer rows, an empty table none.
    is_query is a condition on vec_id.
    """
    ship_package(vectors.sparkSession)
    ready = stage(integer_vectors(vectors, scale).withColumn("is_query", F.coalesce(is_query, F.lit(False))))
    n, asked = ready.agg(F.count("*"), F.count_if("is_query")).first()
    groups, ask_groups = max(1, math.ceil(n / CANDIDATES)), max(1, math.ceil((asked or 0) / QUERIES))
    where = F.xxhash64("vec_id")
    side = F.pmod(where, F.lit(groups)).cast("long")
    ask_side = F.pmod(F.shiftright(where, 20), F.lit(ask_groups)).cast("long")

    def dealt(rows: DataFrame, own: Column, others: int, place, asks: bool) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)).cast("array<long>"))
        return rows.withColumn("own", own).withColumn("other", every).select(
            place(F.col("own"), F.col("other")).alias("cell"), "vec_id", "terms", F.lit(asks).alias("asks")
        )

    cells = dealt(ready, side, ask_groups, lambda own, other: other * groups + own, False).unionByName(
        dealt(ready.filter("is_query"), ask_side, groups, lambda own, other: own * groups + other, True)
    )
    found = cells.groupBy("cell").applyInArrow(_search(k), _FOUND)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), t AS (
  SELECT vec_id, unnest(e) AS x, unnest(range(len(e))) AS term FROM v
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM t q JOIN t c ON q.term = c.term AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY ALL
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
