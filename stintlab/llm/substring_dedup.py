"""Remove passages that repeat across or inside documents: sliding runs of sentences.

Every run of several consecutive sentences is hashed. Hashes are joined over all documents; of a
repeated run the first occurrence, in the document with the smallest id, stays, and in all others
the sentences it covers are removed. Long sentences count as several, so that a run is not out of
reach in text without full stops; they are cut at places their words decide, so that a passage is
cut alike wherever it stands.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import column_slices, kept_by_marks, row_key, ship_package, stage

# Full stops, question and exclamation marks, also of other scripts, and line breaks.
_ENDS = r".!?\n\u0589\u061f\u06d4\u0964\u0965\u104a\u104b\u1362\u1367\u1368\u17d4\u17d5\u203c\u203d\u2047-\u2049\u2028\u2029\u3002\ufe52\ufe56\ufe57\uff01\uff0e\uff1f\uff61"
_PIECES = re.compile(rf"[^{_ENDS}]*[{_ENDS}]+\s*|[^{_ENDS}]+").findall
# Thai, Lao, Tibetan, Myanmar, Khmer, kana and Han: letters of scripts that leave no blanks between words.
_UNSPACED = r"\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_SPACELESS = re.compile(f"[{_UNSPACED}]")
_WORD = re.compile(rf"(?:[{_UNSPACED}]|[^\s{_UNSPACED}]+)\s*").findall
# Two-word hashes on either side that a cut's own is compared with.
_NEAR = 3


@dataclass(frozen=True)
class SpanRules:
    """A run starts at every sentence and is the shortest with both so many sentences and words.

    longest_sentence: sentences of more words are cut, into pieces of no more.
    """

    sentences: int = 3
    words: int = 12
    longest_sentence: int = 12


def words_of(piece: str) -> list[str]:
    """Words between blanks; in scripts without blanks each letter counts as one."""
    return _SPACELESS.sub(r" \g<0> ", piece).split() if not piece.isascii() and _SPACELESS.search(piece) else piece.split()


def _cuts(words: list[str], longest: int) -> list[int]:
    """Words before which a long piece is cut: where the hash of the two words before is the least nearby.

    The places depend on the words around them alone, not on where the piece begins. Where none
    comes for so many words, as in text that repeats one word, there is a cut all the same.
    """
    low = " ".join(words).lower().encode().split(b" ")
    hashes = [crc32(w, crc32(v)) for v, w in zip(low, low[1:])]
    out, last = [], 0
    for i in range(_NEAR - 1, len(hashes) - _NEAR):
        h = hashes[i]
        if h > hashes[i + 1] or h >= hashes[i - 1]:
            continue
        if h <= min(hashes[i + 1 : i + 1 + _NEAR]) and h < min(hashes[max(0, i - _NEAR) : i]):
            out.append(i + 2)
    full = []
    for at in [*out, len(words)]:
        while at - last > longest:
            last += longest
            full.append(last)
        if at < len(words):
            full.append(at)
            last = at
    return full


def sentences_of(text: str, longest: int) -> tuple[list[str], list[list[str]]]:
    """Pieces that make up the text end to end, and the words of each. Blanks go with what is before."""
    parts: list[str] = []
    words: list[list[str]] = []
    for piece in _PIECES(text):
        own = words_of(piece)
        if len(own) > longest:
            spread = _WORD(piece)
            spread[0] = piece[: len(piece) - sum(map(len, spread))] + spread[0]
            edges = [0, *_cuts(own, longest), len(own)]
            for a, b in zip(edges, edges[1:]):
                parts.append("".join(spread[a:b]))
                words.append(own[a:b])
        elif own or not parts:
            parts.append(piece)
            words.append(own)
        else:
            parts[-1] += piece
    return parts, words


# An odd number has an inverse modulo 2 ** 64, so hashes of runs are differences of running sums.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.full(n, base, dtype=np.uint64)]).cumprod(dtype=np.uint64)


def runs_of(texts: list[str | None], rules: SpanRules) -> pd.DataFrame:
    """text (place in texts), hash, a, b (characters), again: seen before in the same text."""
    from xxhash import xxh64_intdigest

    digests: list[int] = []
    counts: list[int] = []
    sizes: list[int] = []
    n: list[int] = []
    for text in texts:
        parts, words = sentences_of(text, rules.longest_sentence) if text else ([], [])
        digests += [xxh64_intdigest(" ".join(w).lower()) for w in words]
        counts += map(len, words)
        sizes += map(len, parts)
        n.append(len(parts))
    total = len(digests)
    ends = np.cumsum(n)
    of = np.repeat(np.arange(len(texts)), n)
    words_before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    chars = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    first = np.arange(total)
    last = np.maximum(first + rules.sentences, np.searchsorted(words_before, words_before[:-1] + rules.words))
    inside = last <= ends[of] if total else np.zeros(0, bool)
    first, last, of = first[inside], last[inside], of[inside]
    with np.errstate(over="ignore"):
        running = np.concatenate([[np.uint64(0)], np.cumsum(np.array(digests, dtype=np.uint64) * _powers(_BASE, total)[:total], dtype=np.uint64)])
        hashes = (running[last] - running[first]) * _powers(_INVERSE, total)[first]
        hashes ^= hashes >> np.uint64(31)
    begin = chars[np.concatenate([[0], ends[:-1]]).astype(np.int64)] if len(texts) else chars
    out = pd.DataFrame({"text": of, "hash": hashes.view(np.int64), "a": chars[first] - begin[of], "b": chars[last] - begin[of]})
    out["again"] = out.duplicated(["text", "hash"])
    return out


# Stands for a null doc_id in the order of documents.
_LAST = 2**63 - 1


def repeated_spans(docs: DataFrame, rules: SpanRules = SpanRules()) -> DataFrame:
    """row, spans: characters from a to b of each run in a document that is not its first, and first_doc.

    Rows equal in doc_id and text are one document, known by row, their row_key, and count once. The
    first is the one with the smallest doc_id and then row; a null doc_id comes after all others.
    """
    ship_package(docs.sparkSession)

    def run(batches):
        for part in column_slices(batches, "text"):
            runs = runs_of(part.column("text").to_pylist(), rules)
            ids, rows = (part.column(c).to_numpy(zero_copy_only=False)[runs["text"]] for c in ("doc_id", "row"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(runs["hash"]), pa.array(ids, pa.int64()), pa.array(rows, pa.int64()),
                 pa.array(runs["a"], pa.int32()), pa.array(runs["b"], pa.int32()), pa.array(runs["again"], pa.bool_())],
                names=["hash", "doc_id", "row", "a", "b", "again"],
            )

    narrow = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc_id"), row_key("doc_id", "text").alias("row"), "text"
    )
    found = stage(narrow.mapInArrow(run, "hash long, doc_id long, row long, a int, b int, again boolean"))
    # Staged on its own, so that the join below starts from two plain shuffles, which Spark can
    # split where one run holds a large part of all rows.
    repeated = stage(
        found.groupBy("hash").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count("*").alias("n"))
        .filter(F.col("n") > 1).select("hash", F.col("first.doc_id").alias("first_doc"), F.col("first.row").alias("first_row"))
    )
    other = (F.col("doc_id") != F.col("first_doc")) | (F.col("row") != F.col("first_row"))
    # Most runs are seen once; they are left out before rows meet.
    often = kept_by_marks(found, "hash", repeated)
    later = often.join(repeated, "hash").filter(other | F.col("again"))
    return later.groupBy("row").agg(
        F.collect_set(F.struct("a", "b")).alias("spans"), F.nullif(F.min("first_doc"), F.lit(_LAST)).alias("first_doc")
    )


def remove_repeated(docs: DataFrame, rules: SpanRules = SpanRules()) -> DataFrame:
    """doc_id, text without repeated runs, n_removed (characters), first_doc (smallest id they were first seen in).

    Needs doc_id and text; other columns are left out. Every row of docs gives one row. A text with
    fewer sentences or words than a run has none, and null stays null. A text that is all repeated
    becomes empty. first_doc is null where nothing is removed, or the first text has no id.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = keyed.withColumn("row", row_key("doc_id", "text"))
    joined = keyed.join(repeated_spans(keyed, rules), "row", "left").select("doc_id", "text", "spans", "first_doc")

    def cut(batches):
        for part in column_slices(batches, "text"):
            texts, removed = part.column("text").to_pylist(), []
            for i, spans in enumerate(part.column("spans").to_pylist()):
                kept, at, text = [], 0, texts[i]
                for s in sorted(spans or [], key=lambda s: (s["a"], s["b"])):
                    if s["b"] > at:
                        kept.append(text[at : max(at, s["a"])])
                        at = s["b"]
                if at:
                    texts[i] = "".join(kept) + text[at:]
                removed.append(len(text or "") - len(texts[i] or ""))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(texts, pa.string()), pa.array(removed, pa.int64()), part.column("first_doc")],
                names=["doc_id", "text", "n_removed", "first_doc"],
            )

    return joined.mapInArrow(cut, "doc_id long, text string, n_removed long, first_doc long")
