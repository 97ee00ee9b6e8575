"""Runs in which the same few words come again and again, by enumeration of maximal pairs.

A maximal pair is two places i < j from which the next l words are equal and the next after those,
like the words before i and j, are not. Then q = j - i is a period of the l + q words from i, and no
neighbour extends them. So the maximal pairs with l + q >= repeats * q (and the least length) are
exactly the runs; a run comes once more for each multiple of its smallest period, which is kept.

Pairs are found bottom-up in the tree of LCP intervals over the suffix array of a document. Each
interval keeps its places in order, and beside each its left-word class. Joining two children, only
places within l / (repeats - 1) of each other can pair. Equal stretches that close overlap, so they
stand at one distance and all but the first have the same left word: a place pairs with all places
after it in reach or with none, and before it with the first in reach or none. What is not reported
is hence not visited, and the smaller child is looked up in the larger one.

Many documents are indexed at once: words are numbered per document, so no match leaves its document.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import column_slices, ship_package

# A run has at least so many words and repeats its period so often.
LEAST_WORDS, REPEATS = 6, 4
# Any pair has at least this many equal words: l >= least - q and l >= (repeats - 1) * q.
_SEED = min(max(LEAST_WORDS - q, (REPEATS - 1) * q) for q in range(1, LEAST_WORDS))

_RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII blanks, as UTF-8; a null text has none."""
    return (text or "").encode().split()


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Number of each combination of keys, in their order."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _ahead(values: np.ndarray, step: int) -> np.ndarray:
    """Each place's value a step further on, different ones past the end."""
    end = np.arange(-1, -1 - min(step, len(values)), -1)
    return np.concatenate([values[step:], end])


def _repeated(values: np.ndarray) -> np.ndarray:
    """Places whose number also stands elsewhere."""
    return np.flatnonzero(np.bincount(values)[values] > 1)


def suffix_clusters(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that share their next words with another place in suffix order, and the common length
    of each with the one before it; 0 starts a new cluster.

    Ranks by 1, 2, 4 and then by the seed's words are refined by doubling, for places that are not
    alone only. Common lengths are read off the ranks of all steps, the longest first.
    """
    rank, have = words, 1
    while have < _SEED:
        step = min(have, _SEED - have)
        rank = _dense(rank, _ahead(rank, step))
        have += step
    places = _repeated(rank)
    # A rank is the number of suffixes before its group, so a refined group stays in its range.
    rank = np.searchsorted(np.sort(rank), rank)
    levels, open_places = [rank.astype(np.int32)], places
    while len(open_places):
        behind = _ahead(rank, have)[open_places]
        own = rank[open_places]
        order = np.lexsort((behind, own))
        own, behind, open_places = own[order], behind[order], open_places[order]
        starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(own))))
        fresh = np.concatenate([[True], (own[1:] != own[:-1]) | (behind[1:] != behind[:-1])])
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(own)), 0))
        rank = rank.copy()
        rank[open_places] = own + first - starts[group]
        levels.append(rank.astype(np.int32))
        sizes = np.diff(np.append(np.flatnonzero(fresh), len(own)))
        open_places = open_places[np.repeat(sizes, sizes) > 1]
        have *= 2
    order = places[np.argsort(rank[places], kind="stable")]
    common = np.zeros(len(order), np.int64)
    a, b, n = order[:-1], order[1:], len(words)

    def advance(level: np.ndarray, step: int) -> None:
        at, other = a + common[1:], b + common[1:]
        inside = np.maximum(at, other) < n
        same = inside & (level[np.minimum(at, n - 1)] == level[np.minimum(other, n - 1)])
        common[1:] += step * same

    for k in range(len(levels) - 1, -1, -1):
        advance(levels[k], _SEED << k)
    for _ in range(_SEED - 1):
        advance(words, 1)
    common[1:][levels[0][a] != levels[0][b]] = 0
    return order, common


def _promising(order: np.ndarray, common: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Clusters, as (begin, end), with two left-word classes and two places near enough to pair."""
    begin = np.flatnonzero(common == 0)
    end = np.append(begin[1:], len(order))
    number = np.repeat(np.arange(len(begin)), end - begin)
    classes = left[order]
    mixed = np.maximum.reduceat(classes, begin) != np.minimum.reduceat(classes, begin)
    in_place = np.lexsort((order, number))
    gap = np.diff(order[in_place], prepend=0)
    gap[begin] = np.iinfo(np.int64).max
    near = np.minimum.reduceat(gap, begin) * (REPEATS - 1) <= np.maximum.reduceat(common, begin)
    return np.stack([begin, end], axis=1)[mixed & near]


def _join_pairs(small: list[int], large: list[int], length: int, left: list[int]):
    """Maximal pairs of common length between two sets of places, both in order."""
    reach = length // (REPEATS - 1)
    for p in small:
        at = bisect_left(large, p)
        if at < len(large) and large[at] - p <= reach and left[large[at]] != left[p]:
            for other in large[at : bisect_right(large, p + reach, at)]:
                yield p, other
        at = bisect_left(large, p - reach, 0, at)
        if at < len(large) and large[at] < p and left[large[at]] != left[p]:
            yield large[at], p


def maximal_pairs(order: list[int], common: list[int], left: list[int]):
    """(i, j, common length) of the maximal pairs of a cluster that are near enough to be runs.

    The intervals of the cluster are closed from the longest common length outwards, on a stack.
    """

    def closed(stack: list, length: int):
        """Join the two topmost sets, which have length words in common."""
        small, large = stack.pop()[1], stack.pop()[1]
        if len(small) > len(large):
            small, large = large, small
        for i, j in _join_pairs(small, large, length, left):
            yield i, j, length
        if 8 * len(small) > len(large):
            large = sorted(chain(large, small))
        else:
            for p in small:
                insort(large, p)
        stack.append((length, large))

    # Entries: common length with the entry below, and places.
    stack: list[tuple[int, list[int]]] = [(0, [order[0]])]
    lengths: list[int] = []
    for place, own in zip(order[1:], common[1:]):
        while lengths and lengths[-1] > own:
            yield from closed(stack, lengths.pop())
        lengths.append(own)
        stack.append((own, [place]))
    while lengths:
        yield from closed(stack, lengths.pop())


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, smallest period) of the runs in numbered words, in order."""
    if len(words) < LEAST_WORDS:
        return []
    order, common = suffix_clusters(words)
    if not len(order):
        return []
    left = np.concatenate([[-1], words[:-1]])
    clusters = _promising(order, common, left)
    if not len(clusters):
        return []
    found: dict[tuple[int, int], int] = {}
    classes = left.tolist()
    for begin, end in clusters.tolist():
        for i, j, length in maximal_pairs(order[begin:end].tolist(), common[begin:end].tolist(), classes):
            period = j - i
            if length + period >= max(LEAST_WORDS, REPEATS * period):
                stretch = (i, j + length)
                found[stretch] = min(period, found.get(stretch, period))
    return sorted((s, e, q) for (s, e), q in found.items())


def _numbered(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all documents, different ones in different documents, and offsets."""
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in chain.from_iterable(documents)], np.int64)
    sizes = np.array([len(d) for d in documents], np.int64)
    owner = np.repeat(np.arange(len(documents)), sizes)
    return _dense(owner, ids), np.concatenate([[0], np.cumsum(sizes)])


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period), collapsed text for every row of docs.

    Words stand between ASCII blanks. A run is a stretch of at least 6 words that repeats its smallest
    period at least 4 times and that no neighbouring word extends. The collapsed text keeps the words
    outside runs and the first period of each, joined by one blank. Needs doc_id and text; other columns
    are left out. A null, empty or blank text has no words, no runs and an empty collapsed text. Texts are
    read whole; repeated rows give repeated rows, an empty table an empty one.
    """
    ship_package(docs.sparkSession)

    def run(batches):
        for part in column_slices(batches, "text"):
            documents = [words_of(t) for t in part.column("text").to_pylist()]
            ids, offsets = _numbered(documents)
            by_document: list[list] = [[] for _ in documents]
            found = runs_of(ids)
            for (s, e, q), d in zip(found, (np.searchsorted(offsets, [r[0] for r in found], "right") - 1).tolist()):
                by_document[d].append((s - int(offsets[d]), e - s, q))
            collapsed = []
            for words, own in zip(documents, by_document):
                if own:
                    kept = np.ones(len(words), bool)
                    for s, n, q in own:
                        kept[s + q : s + n] = False
                    words = [words[i] for i in np.flatnonzero(kept).tolist()]
                collapsed.append(b" ".join(words).decode())
            records = [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in by_document]
            one = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(d) for d in documents], pa.int64()),
                 pa.array(records, pa.list_(one)), pa.array(collapsed, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _RUNS)


def loop_tails(docs: DataFrame) -> DataFrame:
    """Documents whose id asks for it with their tail replaced by one stretch of it, over and over.

    Let h be the crc32 of the decimal id and g = h div 10. Where h mod 10 is 0 and there are n > 0 words,
    word i from a = g mod n on becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Texts of
    other rows, those without an id among them, stay. Gives doc_id and text.
    """
    ship_package(docs.sparkSession)

    def looped(doc_id: int | None, text: str | None) -> str | None:
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        words = words_of(text) if h % 10 == 0 else []
        if not words:
            return text
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)]).decode()

    def run(batches):
        for part in column_slices(batches, "text"):
            rows = zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
            texts = pa.array([looped(i, t) for i, t in rows], pa.string())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), texts], names=["doc_id", "text"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, "doc_id long, text string")


def _strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first by start, then period."""

    def better(best: Column, r: Column) -> Column:
        gain = r["length"] * best["period"] > best["length"] * r["period"]
        return F.when(best.isNull() | gain, r).otherwise(best)

    kind = "struct<start:long,length:long,period:long>"
    return F.aggregate(runs, F.lit(None).cast(kind), better)


def digest(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the strongest one, and SHA-256 of all runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    best = found.withColumn("best", _strongest(F.col("runs")))
    length, period = F.col("best.length"), F.col("best.period")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        length.alias("length"), period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
