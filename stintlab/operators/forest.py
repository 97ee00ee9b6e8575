"""Isolation forest (Liu, Ting and Zhou, ICDM 2008) fitted and applied as Spark jobs.

Spark draws the sample of every tree, one small group per tree grows it, and the forest is a
table of nodes. Scoring sends only the feature columns through Arrow.

Every random choice is the md5 of a text that names it (seed, tree, and lap or node), so a forest
depends on the rows alone, not on their order, their partitioning or any size limit, and any engine
with md5 can grow the same one.
"""

from __future__ import annotations

import hashlib
import logging
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stintlab.config import RULES, SCALE, Rules, Scale
from stintlab.operators.quantiles import exact_quantiles
from stintlab.schemas import ANOMALY_FEATURES, LAP_ORDER, STINT_KEYS, require
from stintlab.sources.shipping import give_back, ship_package
from stintlab.sources.tables import path_exists, stage, write_table

log = logging.getLogger("stintlab")

# One row per node. Nodes are numbered as in a heap: children of i are 2i+1 and 2i+2. A leaf has
# feature -1 and the path length it stands for.
NODE_DDL = "tree int, node int, feature int, split double, path double"

# How many rows are drawn per tree before its sample is cut to size.
_DRAW_MARGIN = 1.5
# Hexadecimal digits of an md5 that make a number, and how many numbers there are.
_DIGITS, _NUMBERS = 13, float(1 << 52)


def mean_path(rows: float) -> float:
    """Mean depth of an unsuccessful search in a binary search tree of that many rows."""
    if rows <= 1:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (math.log(rows - 1) + np.euler_gamma) - 2.0 * (rows - 1) / rows


@dataclass(frozen=True)
class Forest:
    nodes: DataFrame
    features: list[str]
    sample_size: int
    trees: int
    contamination: float
    trained_rows: int
    offset: float

    def save(self, path: str) -> None:
        spark = self.nodes.sparkSession
        write_table(self.nodes, f"{path}/nodes")
        about = [
            (
                self.features, self.sample_size, self.trees,
                self.contamination, self.trained_rows, self.offset,
            )
        ]
        ddl = (
            "features array<string>, sample_size int, trees int, "
            "contamination double, trained_rows bigint, offset double"
        )
        write_table(spark.createDataFrame(about, ddl), f"{path}/about")


def load_forest(spark: SparkSession, path: str) -> Forest | None:
    """A saved forest, or None if there is none."""
    if not path_exists(spark, f"{path}/about"):
        return None
    about = spark.read.parquet(f"{path}/about").first()
    return Forest(nodes=spark.read.parquet(f"{path}/nodes"), **about.asDict())


def training_frame(features: DataFrame, columns: list[str] = ANOMALY_FEATURES) -> DataFrame:
    """Clean laps with every model input known."""
    require(features, ["clean_lap", *columns], "training frame")
    return features.filter(F.coalesce(F.col("clean_lap"), F.lit(False))).dropna(subset=columns)


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts as text."""
    text = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(text, 1, _DIGITS), 16, 10).cast("double") / F.lit(_NUMBERS)


def _uniform_of(*parts: object) -> float:
    text = hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()
    return int(text[:_DIGITS], 16) / _NUMBERS


def draw_samples(
    training: DataFrame, columns: list[str], keys: list[str], rows: int, size: int, rules: Rules
) -> DataFrame:
    """(tree, key, chance, features): the sample of each tree, the size rows with least chance.

    Whether a row may be in a tree is a matter of its key and the number of rows only. A first
    number leaves out, before rows meet trees, those that will be in none: with n rows some
    trees * size of them are kept whatever n is.
    """
    share = min(1.0, _DRAW_MARGIN * size / rows)
    any_tree = min(1.0, share * rules.trees)
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    seed = F.lit(rules.forest_seed)
    narrow = training.select(key.alias("key"), *[F.col(c).cast("double").alias(c) for c in columns])
    kept = narrow.filter(_uniform(seed, F.lit("row"), F.col("key")) < any_tree)
    trees = F.explode(F.sequence(F.lit(0), F.lit(rules.trees - 1)))
    drawn = (
        kept.withColumn("tree", trees)
        .withColumn("chance", _uniform(seed, F.col("tree"), F.col("key")))
        .filter(F.col("chance") < share / any_tree)
    )
    first = Window.partitionBy("tree").orderBy("chance", "key", *columns)
    return (
        drawn.withColumn("_place", F.row_number().over(first))
        .filter(F.col("_place") <= size)
        .drop("_place")
    )


def _grow(
    rows: np.ndarray, depth_limit: int, seed: int, tree: int
) -> Iterator[tuple[int, int, float, float]]:
    """Nodes of one tree: a feature among those that vary and a split in its range, by md5."""
    waiting = [(0, 0, rows)]
    while waiting:
        node, depth, part = waiting.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= depth_limit or len(varying) == 0:
            yield node, -1, 0.0, depth + mean_path(len(part))
            continue
        pick = _uniform_of(seed, tree, node, "feature")
        feature = int(varying[int(pick * len(varying))])
        span = float(high[feature]) - float(low[feature])
        split = float(low[feature]) + _uniform_of(seed, tree, node, "split") * span
        # A split at the lower end would leave one side empty.
        if not split > low[feature]:
            split = float(high[feature])
        left = part[:, feature] < split
        yield node, feature, split, 0.0
        waiting.append((2 * node + 1, depth + 1, part[left]))
        waiting.append((2 * node + 2, depth + 1, part[~left]))


class TooFewRows(ValueError):
    """There is not enough to train on."""


def fit_forest(
    training: DataFrame,
    columns: list[str] = ANOMALY_FEATURES,
    rules: Rules = RULES,
    scale: Scale = SCALE,
    keys: list[str] | None = None,
) -> Forest:
    """Fit on training rows; keys name a row, by default as laps are named."""
    keys = keys or [*STINT_KEYS, *LAP_ORDER]
    ship_package(training.sparkSession)
    rows = training.count()
    if rows < rules.min_training_rows:
        raise TooFewRows(f"{rows} training rows, need {rules.min_training_rows}")
    size = min(rules.tree_sample, rows)
    depth_limit = math.ceil(math.log2(max(size, 2)))
    seed = rules.forest_seed

    def grow(key, group):
        give_back()
        tree = int(key[0])
        # The sample is in a fixed order, though no node depends on it.
        sample = group.sort_values(["chance", "key"])[columns].to_numpy(dtype=np.float64)
        nodes = pd.DataFrame(
            list(_grow(sample, depth_limit, seed, tree)), columns=["node", "feature", "split", "path"]
        )
        nodes.insert(0, "tree", tree)
        return nodes

    drawn = draw_samples(training, columns, keys, rows, size, rules)
    nodes = stage(drawn.groupBy("tree").applyInPandas(grow, NODE_DDL))
    draft = Forest(nodes, list(columns), size, rules.trees, rules.contamination, rows, math.nan)
    scores = training.select(raw_score(draft).alias("score"))
    (cut,) = exact_quantiles(scores, "score", [rules.contamination], scale)
    return Forest(nodes, list(columns), size, rules.trees, rules.contamination, rows, float(cut))


class _Walker:
    """The forest as arrays: every tree a complete tree, early leaves extended to the left."""

    def __init__(self, forest: Forest):
        # Bounded by trees and sample size, whatever the data: 2 * trees * sample_size nodes.
        nodes = forest.nodes.toPandas()
        self.depth = int(np.log2(nodes["node"].max() + 1)) if len(nodes) else 0
        inner = (1 << self.depth) - 1
        trees = forest.trees
        self.feature = np.zeros((trees, max(inner, 1)), dtype=np.int64)
        self.split = np.full((trees, max(inner, 1)), np.inf)
        self.path = np.zeros((trees, inner + 1))
        for row in nodes.itertuples(index=False):
            if row.feature >= 0:
                self.feature[row.tree, row.node] = row.feature
                self.split[row.tree, row.node] = row.split
                continue
            end = row.node
            while end < inner:
                end = 2 * end + 1
            self.path[row.tree, end - inner] = row.path
        self.norm = mean_path(forest.sample_size)

    def score(self, rows: np.ndarray) -> np.ndarray:
        if np.isnan(rows).any():
            raise ValueError("model inputs must be known")
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, split, path in zip(self.feature, self.split, self.path):
            at = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (rows[every, feature[at]] >= split[at])
            total += path[at - (len(path) - 1)]
        # Sums in another order differ in the last digits; equal ones have to stay equal.
        return -np.exp2(-np.round(total, 9) / len(self.path) / self.norm)


def raw_score(forest: Forest) -> Column:
    """Score of each row in (-1, 0); lower is stranger; null where an input is unknown."""
    spark = forest.nodes.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(_Walker(forest))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        give_back()
        walker = shared.value
        for batch in batches:
            rows = np.column_stack([s.to_numpy(dtype=np.float64) for s in batch])
            known = ~np.isnan(rows).any(axis=1)
            out = np.full(len(rows), np.nan)
            if known.any():
                out[known] = walker.score(rows[known])
            yield pd.Series(out).where(known, None)

    return score(*[F.col(c).cast("double") for c in forest.features])


def score_events(events: DataFrame, forest: Forest | None) -> DataFrame:
    """Add anomaly_score and is_anomaly to all laps, clean or not.

    Without a forest, or without one of its inputs, scores are null and flags false.
    """
    missing = [] if forest is None else [c for c in forest.features if c not in events.columns]
    if forest is None or missing:
        log.warning("no anomaly scores: %s", f"missing {missing}" if missing else "no model")
        return events.withColumns(
            {"anomaly_score": F.lit(None).cast("double"), "is_anomaly": F.lit(False)}
        )
    known = F.lit(True)
    for c in forest.features:
        known = known & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    out = events.withColumn("anomaly_score", F.when(known, raw_score(forest)))
    flag = F.coalesce(F.col("anomaly_score") < forest.offset, F.lit(False))
    return out.withColumn("is_anomaly", flag)
