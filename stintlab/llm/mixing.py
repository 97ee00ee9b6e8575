"""Mix sources to target weights by weighted fair queueing.

Each source is a queue of its documents in an order fixed by a hash. A document's virtual finish
time is the source's tokens up to and with it, divided by the source's target. All documents of all
sources in order of that time, cut where the budget is used up, are the mix. A source that may
repeat goes on with a second round of the same order.

No source is ever in one task: its queue is cut by hash into blocks of about the square root of
its rows, and running sums carry one number per block. The cut is found the same way, on buckets of
virtual time, with rows looked at only in the bucket the budget ends in.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlab.llm.common import row_key, stage

WORD = r"[^\x20\x09-\x0D]+"
_HASH_SPAN = float(1 << 32)


@dataclass(frozen=True)
class MixRules:
    """Weights go round the sources in code point order; share is of the size of all sources."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    rounds: int = 2
    seed: str = "mix"


def source_targets(sizes: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """source, source_size, n, target from a table of source and size.

    Targets share the budget by weight. One above `rounds` times its source's size stops there and
    the excess goes to the others by weight: with sources in order of cap per weight, the first
    whose cap is not reached at the level that the rest of the budget allows fixes that level.
    The windows without a partition run over one row per source.
    """
    by_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n")
    )
    everything = Window.partitionBy()
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(w) for w in rules.weights])
    weighed = (
        by_source.withColumn("weight", F.element_at(weights, (turn % len(rules.weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * float(rules.rounds))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    ordered = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    onward = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * rules.share
    levels = weighed.withColumn(
        "level", (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    )
    # Of equal caps per weight the first counts, whose level is the highest.
    reached = F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", (-F.col("level")).alias("under")))
    level = -F.min(reached).over(everything)["under"]
    return levels.withColumn("at", level).select(
        "source", "source_size", "n",
        F.when(F.col("at").isNull(), F.col("cap"))
        .otherwise(F.least("cap", F.col("weight") * F.col("at")))
        .alias("target"),
    )


def mix(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """One row per document: doc_id, key, size, source, source_size, target, copies, taken.

    Needs doc_id, text and source; other columns are left out, so their names cannot clash. A null
    text has size 0, a null source is a source of its own, a null doc_id is ordered like any value.
    A document without words is taken when its turn comes before the cut and adds nothing; one
    whose source has no words at all is not taken. Rows equal in doc_id and text share one fate. An
    empty table gives an empty result. key is a hash of doc_id, source and text to join by.
    """
    order = F.md5(F.concat(F.lit(f"{rules.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    base = stage(
        docs.select(
            "doc_id", "source", row_key("doc_id", "source", "text").alias("key"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            order.alias("turn"),
        )
    )
    targets = stage(source_targets(base, rules))
    totals = targets.agg(F.sum("source_size"), F.sum("n")).first()
    budget, rows = (totals[0] or 0) * rules.share, totals[1] or 0

    same = base["source"].eqNullSafe(targets["source"])
    placed = base.join(targets, same, "left").drop(targets["source"])
    position = F.conv(F.substring("turn", 1, 8), 16, 10).cast("double") / _HASH_SPAN
    blocked = placed.withColumn("block", F.floor(position * F.ceil(F.sqrt("n"))))
    sums = blocked.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        F.col("source").alias("s"), F.col("block").alias("b"),
        F.coalesce(F.sum("block_size").over(earlier), F.lit(0)).alias("carried"),
    )
    inside = (
        Window.partitionBy("source", "block").orderBy("turn", "doc_id", "key")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    queued = stage(
        blocked.withColumn("within", F.sum("size").over(inside))
        .join(carried, blocked["source"].eqNullSafe(F.col("s")) & (blocked["block"] == F.col("b")))
        .withColumn("reached", F.col("within") + F.col("carried"))
        .drop("s", "b", "block", "within", "carried", "n")
    )

    def finish(nth: int) -> Column:
        passed = F.col("reached") + F.col("source_size") * nth
        return F.when(F.col("target") > 0, passed / F.col("target"))

    buckets = max(1, math.ceil(math.sqrt(rows)))

    def bucket(time: Column) -> Column:
        return F.floor(time / (time + 1.0) * buckets)

    times = F.array(*[finish(i) for i in range(rules.rounds)])
    items = (
        queued.select("size", "turn", "doc_id", "key", F.explode(times).alias("time"))
        .filter(F.col("time").isNotNull()).withColumn("bucket", bucket(F.col("time")))
    )
    so_far = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = (
        items.groupBy("bucket").agg(F.sum("size").alias("bucket_size"))
        .withColumn("filled", F.sum("bucket_size").over(so_far))
    )
    crossed = filled.filter(F.col("filled") > budget).orderBy("bucket").first()

    def rank(time: Column) -> Column:
        return F.struct(time.alias("time"), F.col("turn"), F.col("doc_id"), F.col("key"))

    if crossed is None:
        before_cut = lambda time: time.isNotNull()
    else:
        room = budget - (crossed["filled"] - crossed["bucket_size"])
        by_rank = Window.orderBy("time", "turn", "doc_id", "key").rowsBetween(Window.unboundedPreceding, 0)
        last = (
            items.filter(F.col("bucket") == crossed["bucket"])
            .withColumn("used", F.sum("size").over(by_rank))
            .filter(F.col("used") <= room).agg(F.max(rank(F.col("time"))).alias("at")).first()["at"]
        )

        def before_cut(time: Column) -> Column:
            earlier_bucket = bucket(time) < crossed["bucket"]
            if last is None:
                return earlier_bucket
            bound = F.struct(
                F.lit(last["time"]).alias("time"), F.lit(last["turn"]).alias("turn"),
                F.lit(last["doc_id"]).cast(queued.schema["doc_id"].dataType).alias("doc_id"),
                F.lit(last["key"]).alias("key"),
            )
            return earlier_bucket | ((bucket(time) == crossed["bucket"]) & (rank(time) <= bound))

    copies = sum(
        (F.when(F.coalesce(before_cut(finish(i)), F.lit(False)), 1).otherwise(0) for i in range(rules.rounds)),
        F.lit(0),
    )
    return queued.withColumn("copies", copies).select(
        "doc_id", "key", "size", "source", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def repeat_taken(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of docs."""
    taken = (
        mix(docs, rules).groupBy("key").agg(F.sum("copies").alias("all_copies"), F.count("*").alias("alike"))
    )
    # Rows are carried as one value, so that their columns may have any names.
    rows = docs.select(F.struct("*").alias("_row"), row_key("doc_id", "source", "text").alias("_key"))
    taken = taken.filter("all_copies > 0").withColumnRenamed("key", "_key")
    # Equal rows split their copies between them.
    nth = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    own = F.floor(F.col("all_copies") / F.col("alike")) + F.when(
        nth <= F.col("all_copies") % F.col("alike"), 1
    ).otherwise(0)
    return (
        rows.join(taken, "_key").withColumn("_own", own).filter("_own > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_own").cast("int"))))
        .select("_row.*")
    )


SQL = r"""
WITH base AS (
  SELECT doc_id, source, md5('mix:' || coalesce(cast(doc_id AS VARCHAR), 'null')) AS turn,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source
), weighed AS (
  SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS weight,
         source_size * 2.0::DOUBLE AS cap
  FROM src
), levels AS (
  SELECT *, cap / weight AS ratio,
         ((SELECT sum(source_size) FROM src) * 1.5::DOUBLE
           - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), fixed AS (
  SELECT level AS at_level FROM levels WHERE ratio >= level ORDER BY ratio, level DESC LIMIT 1
), targets AS (
  SELECT source, source_size, coalesce(least(cap, weight * (SELECT at_level FROM fixed)), cap) AS target FROM levels
), queued AS (
  SELECT b.doc_id, b.size, b.turn, t.source_size, t.target,
         sum(b.size) OVER (PARTITION BY b.source ORDER BY b.turn, b.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reached
  FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source
), items AS (
  SELECT doc_id, size, turn, r, (reached + r * source_size) / target AS finish
  FROM queued, (SELECT 0 AS r UNION ALL SELECT 1) WHERE target > 0
), cut AS (
  SELECT doc_id, sum(size) OVER (ORDER BY finish, turn, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used
  FROM items
), copies AS (
  SELECT doc_id, count(*) AS n FROM cut
  WHERE used <= (SELECT sum(source_size) FROM src) * 1.5 GROUP BY doc_id
)
SELECT q.doc_id, q.size, q.source_size, floor(q.target * 1e6 + 0.5) / 1e6 AS target,
       CAST(q.size * coalesce(c.n, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN copies c ON q.doc_id = c.doc_id
"""
