"""Find benchmark items inside training documents: BM25, block-max WAND, then overlap.

Test items are the indexed collection and training passages the queries. Items are cut into pieces
of bounded length; the BM25 impacts of a piece's words are scaled so that a passage holding all of
them scores ONE. Postings are kept in blocks with their largest impact, and block-max WAND returns
every piece that a passage scores at least the threshold on. A match counts once the item's question
and answer (its last sentence) are verified to overlap the document around the passage.

Impacts are whole numbers, so a score is the same in any order of adding. The index is broadcast in
shards of bounded size; documents are never shuffled.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import column_slices, lean, ship_package, stage

ONE = 1_000_000
_WORDS = re.compile(r"\w+").findall
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


@dataclass(frozen=True)
class LeakRules:
    """A passage has twice the words of a piece and starts each piece length, so a copy lies in one."""

    piece_words: int = 64
    threshold: float = 0.5
    k1: float = 1.2
    b: float = 0.75
    block: int = 32
    # Share of a piece's score that may be left to its commonest words when passages are skipped.
    common_share: float = 0.25
    gram: int = 3
    part_overlap: float = 0.5
    question_alone: float = 0.9
    # Postings of one broadcast shard of the index.
    shard_postings: int = 1_000_000


def words_of(text: str | None) -> list[str]:
    return _WORDS(text.lower()) if text else []


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The answer is the last sentence, of a single sentence its last quarter."""
    parts = [w for w in map(words_of, _SENTENCE_END.split(text.strip())) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - len(words) // 4
    return words[:cut], words[cut:]


def _cut(words: list[str], most: int) -> list[list[str]]:
    n = math.ceil(len(words) / most)
    return [words[len(words) * i // n : len(words) * (i + 1) // n] for i in range(n)]


class BlockMaxIndex:
    """Postings of pieces by word, in ascending order of piece."""

    def __init__(self, pieces: list[tuple[int, dict[str, int]]], rules: LeakRules):
        self.items = [item for item, _ in pieces]
        self.threshold = math.ceil(rules.threshold * ONE)
        self.block = rules.block
        postings: dict[str, tuple[list[int], list[int]]] = defaultdict(lambda: ([], []))
        for piece, (_, impacts) in enumerate(pieces):
            for word, impact in impacts.items():
                postings[word][0].append(piece)
                postings[word][1].append(impact)
        self.postings = dict(postings)
        self.largest = {w: max(i) for w, (_, i) in postings.items()}
        self.block_max = {w: [max(i[a : a + rules.block]) for a in range(0, len(i), rules.block)] for w, (_, i) in postings.items()}
        # Of each piece the words seen in most pieces, then the shortest, are left out while their
        # impacts stay below common_share. No passage without the others reaches the threshold.
        self.left: list[int] = []
        essential: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for piece, (_, impacts) in enumerate(pieces):
            left, room = 0, min(rules.common_share * ONE, self.threshold - 1)
            for word in sorted(impacts, key=lambda w: (-len(postings[w][0]), len(w), w)):
                if left + impacts[word] <= room:
                    left += impacts[word]
                else:
                    essential[word].append((piece, impacts[word]))
            self.left.append(left)
        self.essential = dict(essential)

    def may_match(self, words) -> bool:
        """False if no piece can reach the threshold with these distinct words."""
        found: dict[int, int] = defaultdict(int)
        for word in words:
            for piece, impact in self.essential.get(word, ()):
                found[piece] += impact
        return any(n + self.left[piece] >= self.threshold for piece, n in found.items())

    def search(self, words) -> dict[int, int]:
        """Every piece with a score of at least the threshold, by block-max WAND."""
        lists = [(w, *self.postings[w]) for w in words if w in self.postings]
        at = [0] * len(lists)
        out: dict[int, int] = {}
        live = list(range(len(lists)))
        while True:
            live = [i for i in live if at[i] < len(lists[i][1])]
            live.sort(key=lambda i: lists[i][1][at[i]])
            bound, pivot = 0, -1
            for n, i in enumerate(live):
                bound += self.largest[lists[i][0]]
                if bound >= self.threshold:
                    pivot = n
                    break
            if pivot < 0:
                return out
            piece = lists[live[pivot]][1][at[live[pivot]]]
            while pivot + 1 < len(live) and lists[live[pivot + 1]][1][at[live[pivot + 1]]] == piece:
                pivot += 1
            ahead = live[: pivot + 1]
            # Blocks that would hold the pivot, and the first piece beyond the shortest of them.
            bound, beyond = 0, len(self.items)
            for i in ahead:
                word, pieces, _ = lists[i]
                place = bisect_left(pieces, piece, at[i])
                if place < len(pieces):
                    block = place // self.block
                    bound += self.block_max[word][block]
                    last = pieces[min(len(pieces), (block + 1) * self.block) - 1]
                    beyond = min(beyond, last + 1)
            if bound >= self.threshold:
                if lists[live[0]][1][at[live[0]]] == piece:
                    score = sum(lists[i][2][at[i]] for i in ahead)
                    if score >= self.threshold:
                        out[piece] = score
                    target = piece + 1
                else:
                    target = piece
            else:
                if pivot + 1 < len(live):
                    beyond = min(beyond, lists[live[pivot + 1]][1][at[live[pivot + 1]]])
                target = max(beyond, piece + 1)
            for i in ahead:
                at[i] = bisect_left(lists[i][1], target, at[i])


@dataclass
class LeakIndex:
    index: BlockMaxIndex
    parts: dict[int, tuple[list[str], list[str]]]
    rules: LeakRules

    def find(self, text: str | None) -> list[tuple[int, float, float, float, int]]:
        """item, best score, overlaps of question and answer, first passage's first word."""
        words = words_of(text)
        distinct = set(words)
        if self.index.essential.keys().isdisjoint(distinct) or not self.index.may_match(distinct):
            return []
        step = self.rules.piece_words
        best: dict[int, tuple[int, int]] = {}
        spans: dict[int, list[int]] = defaultdict(list)
        for start in range(0, max(1, len(words) - step), step):
            passage = set(words[start : start + 2 * step])
            if not self.index.may_match(passage):
                continue
            for piece, score in self.index.search(passage).items():
                item = self.index.items[piece]
                spans[item].append(start)
                best[item] = max(best.get(item, (0, 0)), (score, -start))
        out = []
        for item, starts in spans.items():
            question, answer = self.parts[item]
            reach = len(question) + len(answer) + 2 * step
            around = [w for a in self._merged(starts, reach, len(words)) for w in [words[a[0] : a[1]]]]
            asked, answered = (self._overlap(p, around) for p in (question, answer))
            part = self.rules.part_overlap
            if (asked >= part and answered >= part) or asked >= self.rules.question_alone:
                out.append((item, best[item][0] / ONE, asked, answered, min(starts)))
        return sorted(out)

    @staticmethod
    def _merged(starts: list[int], reach: int, n: int) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for s in sorted(starts):
            a, b = max(0, s - reach), min(n, s + reach)
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
        return out

    def _overlap(self, part: list[str], around: list[list[str]]) -> float:
        """Share of the part's word n-grams found; a part without words has nothing to deny it."""
        n = min(self.rules.gram, len(part))
        if not n:
            return 1.0
        wanted = {tuple(part[i : i + n]) for i in range(len(part) - n + 1)}
        got = {tuple(w[i : i + n]) for w in around for i in range(len(w) - n + 1)}
        return len(wanted & got) / len(wanted)


_TERMS = "item_id long, piece int, word string, times int, piece_length int"


def leak_indexes(benchmark: DataFrame, rules: LeakRules = LeakRules()) -> list[LeakIndex]:
    """Indexes over benchmark (item_id, text), one per shard; an empty list without any words.

    Document frequencies, mean length and impacts are computed in Spark over the whole benchmark, so
    scores do not depend on the shards. Null texts and null ids are not indexed; of equal ids one
    text, the smallest, stays.
    """
    ship_package(benchmark.sparkSession)
    items = (
        benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
        .groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.min("text").alias("text"))
    )

    def cut(batches):
        for part in column_slices(batches, "text"):
            rows = []
            for item, text in zip(part.column("item_id").to_pylist(), part.column("text").to_pylist()):
                for n, piece in enumerate(_cut(words_of(text), rules.piece_words) if words_of(text) else []):
                    times: dict[str, int] = defaultdict(int)
                    for w in piece:
                        times[w] += 1
                    rows += [(item, n, w, t, len(piece)) for w, t in times.items()]
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["item_id", "piece", "word", "times", "piece_length"]
            )

    terms = stage(items.mapInArrow(lean(cut), _TERMS))
    sizes = terms.select("item_id", "piece", "piece_length").distinct()
    n, mean = sizes.agg(F.count("*"), F.avg("piece_length")).first()
    postings = terms.count()
    if not n:
        return []
    spread = terms.groupBy("word").agg(F.count("*").alias("df"))
    rarity = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    damped = rules.k1 * (1 - rules.b + rules.b * F.col("piece_length") / mean)
    raw = terms.join(spread, "word").withColumn("impact", rarity * F.col("times") * (rules.k1 + 1) / (F.col("times") + damped))
    own = raw.groupBy("item_id", "piece").agg(F.sum("impact").alias("own"))
    shards = math.ceil(postings / rules.shard_postings)
    scaled = stage(
        raw.join(own, ["item_id", "piece"]).select(
            "item_id", "piece", "word", F.round(F.col("impact") / F.col("own") * ONE).cast("long").alias("impact"),
            F.pmod(F.xxhash64("item_id"), F.lit(shards)).alias("shard"),
        )
    )
    out = []
    for shard in range(shards):
        pieces: dict[tuple[int, int], dict[str, int]] = defaultdict(dict)
        for r in scaled.filter(F.col("shard") == shard).orderBy("item_id", "piece", "word").collect():
            pieces[r["item_id"], r["piece"]][r["word"]] = r["impact"]
        texts = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == shard).collect()
        index = BlockMaxIndex([(item, impacts) for (item, _), impacts in sorted(pieces.items())], rules)
        out.append(LeakIndex(index, {r["item_id"]: question_and_answer(r["text"]) for r in texts}, rules))
    return out


_LEAKS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"


def find_leaks(docs: DataFrame, indexes: list[LeakIndex]) -> DataFrame:
    """One row per document and benchmark item it holds.

    Needs doc_id and text; other columns are left out. Null and empty texts hold nothing; repeated
    rows give repeated matches. Texts are searched whole. Without an index there are no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def search(index: LeakIndex) -> DataFrame:
        shared = spark.sparkContext.broadcast(index)

        def run(batches):
            for part in column_slices(batches, "text"):
                rows = [
                    (doc, *found)
                    for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
                    for found in shared.value.find(text)
                ]
                columns = list(zip(*rows)) if rows else [[]] * 6
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
                names = [c.split()[0] for c in _LEAKS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        return narrow.mapInArrow(lean(run), _LEAKS)

    found = spark.createDataFrame([], _LEAKS)
    for index in indexes:
        found = search(index) if index is indexes[0] else found.unionByName(search(index))
    return found


def drop_leaks(docs: DataFrame, indexes: list[LeakIndex]) -> DataFrame:
    """Rows of docs that hold no benchmark item, as they are. Needs text; other columns may have any names."""
    spark = docs.sparkSession
    ship_package(spark)
    for index in indexes:
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for part in column_slices(batches, "text"):
                clean = [not shared.value.find(t) for t in part.column("text").to_pylist()]
                yield part.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(lean(run), docs.schema)
    return docs
