"""Quality of texts, learned from trusted positives and unlabelled text alone.

The classifier minimises the non-negative risk of positive-unlabelled learning: with class prior p,
the risk of calling positives negative is taken out of the risk of calling unlabelled text negative,
and what is left, the risk over true negatives, may not fall below zero. The prior is the share of
positives among labelled rows. Features are properties of the text, each cut at quantiles of the
unlabelled sample, with one weight per piece.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import column_slices, hash_share, ship_package


@dataclass(frozen=True)
class QualityRules:
    """sample_rows: positives, and unlabelled texts, that are fitted on; drawn by hash."""

    sample_rows: int = 8000
    pieces: int = 24
    steps: int = 1000
    rate: float = 0.1
    decay: float = 1e-4
    least_prior: float = 0.05


FEATURES = (
    "bytes", "letters", "upper", "digits", "blanks", "lines", "beyond_ascii", "stops", "exclaim",
    "bars", "marks", "brackets", "words", "word_length", "longest_word", "distinct_words", "top_word",
    "line_words", "repeated_lines", "repeated_pairs", "compressed", "stopped_words",
)
_CLASS = np.zeros(256, dtype=np.int64)
for _i, _signs in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", bytes(range(128, 256)),
     b".,;:?", b"!", b"|", b"#$%&*+~^=", b"<>{}[]()/\\_@\"'`-"), start=1
):
    _CLASS[list(_signs)] = _i


def text_features(text: str | None) -> list[float]:
    """One number per name in FEATURES; a null text has those of an empty one."""
    raw = (text or "").encode()
    n = max(1, len(raw))
    by_class = np.bincount(_CLASS[np.frombuffer(raw, dtype=np.uint8)], minlength=12)
    _, lower, upper, digits, blanks, breaks, beyond, stops, exclaim, bars, marks, brackets = by_class.tolist()
    letters = lower + upper + beyond
    words = (text or "").split()
    count = max(1, len(words))
    times = Counter(words)
    lines = [x for x in (text or "").split("\n") if x]
    pairs = Counter(zip(words, words[1:]))
    return [
        np.log1p(len(raw)), letters / n, upper / max(1, letters), digits / n, blanks / n, breaks / n, beyond / n,
        stops / count, exclaim / count, bars / count, marks / count, brackets / count,
        np.log1p(len(words)), sum(map(len, words)) / count, np.log1p(max(map(len, words), default=0)),
        len(times) / count, max(times.values(), default=0) / count, np.log1p(count / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)), 1 - len(pairs) / max(1, count - 1),
        len(zlib.compress(raw, 1)) / n, sum(map(str.isalpha, times)) / max(1, len(times)),
    ]


@dataclass
class QualityModel:
    edges: np.ndarray  # features by inner edges
    weights: np.ndarray  # features by pieces
    bias: float
    prior: float

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_margin(_pieces(features, self.edges), self.weights, self.bias), -30, 30)))


def _pieces(features: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(e, f, side="right") for e, f in zip(edges, features.T)], axis=1)


def _margin(pieces: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    return weights[np.arange(len(weights)), pieces].sum(axis=1) + bias


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, rules: QualityRules = QualityRules()) -> QualityModel:
    """Logistic loss, full gradient steps. Without samples every text scores the prior."""
    k = positive.shape[1]
    bias = float(np.log(prior / (1 - prior)))
    cuts = np.linspace(0, 1, rules.pieces + 1)[1:-1]
    if not len(positive) or not len(unlabelled):
        return QualityModel(np.zeros((k, rules.pieces - 1)), np.zeros((k, rules.pieces)), bias, prior)
    edges = np.quantile(unlabelled, cuts, axis=0).T
    groups = [_pieces(positive, edges), _pieces(unlabelled, edges)]
    flat = [(g + np.arange(k) * rules.pieces) for g in groups]
    weights, size = np.zeros((k, rules.pieces)), k * rules.pieces
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, rules.steps + 1):
        p, u = (1 / (1 + np.exp(-_margin(g, weights, bias))) for g in groups)
        # Risk of positives as positive; risk of true negatives, as unlabelled less positives.
        left_over = -np.log1p(-np.minimum(u, 1 - 1e-9)).mean() + prior * np.log1p(-np.minimum(p, 1 - 1e-9)).mean()
        down_p, down_u = prior * (p - 1) / len(p), np.zeros(len(u))
        if left_over >= 0:
            down_p, down_u = down_p - prior * p / len(p), u / len(u)
        else:  # the estimate has overshot: step back up
            down_p, down_u = prior * p / len(p), -u / len(u)
        slope = sum(np.bincount(f.ravel(), np.repeat(d, k), minlength=size) for f, d in zip(flat, (down_p, down_u)))
        slope = np.append(slope + rules.decay * weights.ravel(), down_p.sum() + down_u.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = rules.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1].reshape(weights.shape), bias - move[-1]
    return QualityModel(edges, weights, float(bias), prior)


def _features_of(docs: DataFrame) -> np.ndarray:
    def run(batches):
        for part in column_slices(batches, "text"):
            values = [text_features(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.list_(pa.float64()))], names=["x"])

    rows = docs.select("text").mapInArrow(run, "x array<double>").collect()
    # In a fixed order: sums of floating numbers depend on it.
    return np.array(sorted(r["x"] for r in rows)).reshape(len(rows), len(FEATURES))


def train_quality(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> QualityModel:
    """Fit on docs (doc_id, text) and labels (doc_id, quality), both without the rows to hold out.

    A document with several labels is positive if one of them is. Null ids and null labels teach
    nothing. About sample_rows positives and as many documents of any kind, the unlabelled text,
    are drawn by hash of doc_id; their features alone come to the driver.
    """
    ship_package(docs.sparkSession)
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
    )
    n, positives = known.agg(F.count("*"), F.count_if(F.col("quality") == 1)).first()
    prior = min(max((positives or 0) / max(1, n), rules.least_prior), 1 - rules.least_prior)
    share = min(1.0, rules.sample_rows / max(1, positives))
    # At most about sample_rows ids.
    drawn = known.filter((F.col("quality") == 1) & (hash_share(F.col("doc_id"), 5) < share)).select("doc_id")
    trusted = docs.join(F.broadcast(drawn), "doc_id", "left_semi")
    any_share = min(1.0, rules.sample_rows / max(1, docs.count()))
    unlabelled = docs.filter(hash_share(F.coalesce(F.col("doc_id"), F.lit(0)), 6) < any_share)
    return fit_nnpu(_features_of(trusted), _features_of(unlabelled), prior, rules)


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, score (0 to 1), predicted for every row of docs.

    Needs doc_id and text; other columns are left out. Null and empty texts are scored as empty
    ones; repeated rows give repeated rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for part in column_slices(batches, "text"):
            values = np.array([text_features(t) for t in part.column("text").to_pylist()])
            score = shared.value.score(values.reshape(part.num_rows, len(FEATURES)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id long, score double, predicted int")
