"""Language of texts that may mix languages: scripts, character n-grams and Viterbi over words.

Training counts hashed character n-grams of words per language, and the share of a language's
letters in each script. To label a text, the script of each word narrows its candidates, n-grams
score them, and Viterbi with a penalty for switching gives each word a language; runs of one
language are spans. The text gets the language with most letters.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import column_slices, hash_share, lean, ship_package
from stintlab.sources.shipping import kept_in_worker

UNKNOWN = "und"

# First code points of script ranges, in order. Letters below the first are Latin.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "indic"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1C80, "cyrillic"), (0x1C90, "georgian"), (0x1CC0, "other"), (0x1D00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
    (0xFB00, "other"), (0x20000, "han"),
)
_STARTS = np.array([s for s, _ in SCRIPTS])
_NAMES = sorted({n for _, n in SCRIPTS})
_SCRIPT_OF = np.array([_NAMES.index(n) for _, n in SCRIPTS])

_WORDS = re.compile(r"[^\W\d_]+").findall
# Longer words are cut into pieces of so many letters, and words of several scripts where they change.
_WORD_LETTERS = 32
# Distinct words whose n-grams are held at once.
_AT_ONCE = 10_000
# Letters before a cut that the piece after it carries along for its n-grams, at most.
_CARRIED = 8


@dataclass(frozen=True)
class LanguageRules:
    """rows_per_language: labelled texts a language is learned from, drawn by hash."""

    rows_per_language: int = 5000
    buckets: int = 1 << 15
    longest_gram: int = 3
    switch_penalty: float = 8.0
    smoothing: float = 0.5
    # A script counts for a language from this share of its letters on.
    script_share: float = 0.02


@dataclass
class LanguageModel:
    languages: list[str]
    scores: np.ndarray  # buckets by languages: log probability
    scripts: np.ndarray  # scripts by languages: is the script one of the language's
    rules: LanguageRules = field(default_factory=LanguageRules)


@kept_in_worker(maxsize=1 << 16)
def _pieces(word: str) -> tuple[str, ...]:
    """The word, or its pieces of one script and no more than _WORD_LETTERS letters.

    A piece begins with a sign below "0", which no word has: the number of letters carried along
    from before the cut, times two, and one if the word goes on, plus one. Then come those letters.
    """
    scripts = _SCRIPT_OF[np.searchsorted(_STARTS, np.fromiter(map(ord, word), np.int64, len(word)), side="right") - 1]
    cuts = [0]
    for end in [*(np.flatnonzero(np.diff(scripts)) + 1).tolist(), len(word)]:
        cuts += [*range(cuts[-1] + _WORD_LETTERS, end, _WORD_LETTERS), end]
    if len(cuts) == 2:
        return (word,)
    carried = [min(_CARRIED, a) for a in cuts[:-1]]
    return tuple(chr(1 + 2 * c + (b < len(word))) + word[a - c : b] for a, b, c in zip(cuts, cuts[1:], carried))


def _words_of(text: str) -> list[str]:
    words = _WORDS(text.lower())
    if all(w.isascii() and len(w) <= _WORD_LETTERS for w in words):
        return words
    return [p for w in words for p in ((w,) if w.isascii() and len(w) <= _WORD_LETTERS else _pieces(w))]


def _own(word: str) -> str:
    """The letters of a word or of a piece, without those carried along."""
    return word if word[0] >= "0" else word[1 + (ord(word[0]) - 1) // 2 :]


def _codes(words: list[str], rules: LanguageRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words, a mark of 1 before and after each, padded with zeros; where they end; and carried letters.

    A piece has no mark where the word was cut; it starts with the carried letters n-grams need.
    """
    marked, skip = [], np.zeros(len(words), np.int64)
    for i, w in enumerate(words):
        if w[0] >= "0":
            marked.append(f"\x01{w}\x01")
            continue
        carried, on = divmod(ord(w[0]) - 1, 2)
        skip[i] = min(carried, rules.longest_gram - 1)
        marked.append(("" if carried else "\x01") + w[1 + carried - skip[i] :] + ("" if on else "\x01"))
    ends = np.fromiter(map(len, marked), np.int64, len(marked))
    flat = np.frombuffer("".join(marked).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    out = np.zeros((len(marked), int(ends.max(initial=0))), dtype=np.uint64)
    out[np.arange(out.shape[1]) < ends[:, None]] = flat
    return out, ends, skip


def _grams(codes: np.ndarray, ends: np.ndarray, skip: np.ndarray, rules: LanguageRules):
    """Buckets of all n-grams of each word: pairs of (buckets, which of them are real)."""
    at = np.arange(codes.shape[1])
    rolling = np.zeros_like(codes)
    for n in range(1, rules.longest_gram + 1):
        width = codes.shape[1] - n + 1
        if width <= 0:
            break
        rolling = (rolling[:, :width] * np.uint64(0x9E3779B97F4A7C15) + codes[:, n - 1 :][:, :width]) * np.uint64(0xD6E8FEB86659FD93)
        mixed = (rolling ^ (rolling >> np.uint64(29))) + np.uint64(n)
        # Those within the carried letters belong to the piece before.
        yield (mixed % np.uint64(rules.buckets)).astype(np.int64), (at[:width] + n <= ends[:, None]) & (at[:width] + n > skip[:, None])


def _first_script(words: list[str]) -> np.ndarray:
    firsts = np.fromiter((ord(_own(w)[0]) for w in words), np.int64, len(words))
    return _SCRIPT_OF[np.searchsorted(_STARTS, firsts, side="right") - 1]


def _letters(word: str) -> int:
    """Signs that only stand among letters, such as raised digits, are not counted."""
    return len(word) if word.isalpha() else sum(map(str.isalpha, word))


def _distinct(words: list[str]) -> tuple[list[str], np.ndarray]:
    coded = pa.array(words, pa.string()).dictionary_encode()
    return coded.dictionary.to_pylist(), np.asarray(coded.indices)


def train_languages(docs: DataFrame, labelled: Column, rules: LanguageRules = LanguageRules()) -> LanguageModel:
    """Learn from text and lang of the rows for which labelled holds.

    Rows with a null text or lang teach nothing. For each language about rows_per_language rows
    are drawn by a hash of doc_id, all if it has fewer. What comes back to the driver is one count
    per language and n-gram bucket, summed in Spark; its size is fixed by the number of languages.
    """
    ship_package(docs.sparkSession)
    teaching = docs.filter(labelled & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["count"] for r in teaching.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros((rules.buckets, 0), np.float32), np.zeros((len(_NAMES), 0), bool), rules)
    share = F.lit(1.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, rules.rows_per_language / n)).otherwise(share)
    drawn = teaching.filter(hash_share(F.coalesce(F.col("doc_id"), F.lit(0)), 10) < share).select("lang", "text")
    width = rules.buckets + len(_NAMES)

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for part in column_slices(batches, "text"):
            langs = part.column("lang").to_pylist()
            texts = part.column("text").to_pylist()
            for lang in set(langs):
                words = [w for l, t in zip(langs, texts) if l == lang for w in _words_of(t)]
                if not words:
                    continue
                distinct, which = _distinct(words)
                times = np.bincount(which, minlength=len(distinct))
                total = totals.setdefault(lang, np.zeros(width))
                for at in range(0, len(distinct), _AT_ONCE):
                    some = distinct[at : at + _AT_ONCE]
                    lengths = np.fromiter((len(_own(w)) for w in some), np.int64, len(some))
                    weight = times[at : at + _AT_ONCE]
                    for buckets, real in _grams(*_codes(some, rules), rules):
                        total += np.bincount(buckets[real], np.broadcast_to(weight[:, None], real.shape)[real], minlength=width)
                    total += np.bincount(rules.buckets + _first_script(some), weight * lengths, minlength=width)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at, pa.int64()), pa.array(total[at])], names=["lang", "at", "n"]
            )

    counted = drawn.mapInArrow(lean(count), "lang string, at long, n double").groupBy("lang", "at").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((width, len(languages)))
    table[counted["at"].to_numpy(dtype=np.int64), [languages.index(l) for l in counted["lang"]]] = counted["n"].to_numpy(dtype=float)
    grams, letters = table[: rules.buckets] + rules.smoothing, table[rules.buckets :]
    scripts = letters >= rules.script_share * np.maximum(1.0, letters.sum(axis=0))
    return LanguageModel(languages, np.log(grams / grams.sum(axis=0)).astype(np.float32), scripts, rules)


def _word_scores(words: list[str], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Score of each word in each language, -inf where its script excludes one; and letters.

    A word in a script no language was learned in tells nothing and has zeros.
    """
    out = np.zeros((len(words), len(model.languages)), dtype=np.float32)
    sizes = np.zeros(len(words), dtype=np.int64)
    for at in range(0, len(words), _AT_ONCE):
        some = words[at : at + _AT_ONCE]
        score = out[at : at + _AT_ONCE]
        for buckets, real in _grams(*_codes(some, model.rules), model.rules):
            for column in range(buckets.shape[1]):
                rows = np.flatnonzero(real[:, column])
                score[rows] += model.scores[buckets[rows, column]]
        allowed = model.scripts[_first_script(some)]
        known = allowed.any(axis=1)
        score[~known] = 0.0
        score[known[:, None] & ~allowed] = -np.inf
        sizes[at : at + _AT_ONCE] = np.fromiter((_letters(_own(w)) for w in some), np.int64, len(some))
    return out, sizes


def _viterbi(scores: np.ndarray, which: np.ndarray, starts: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of every word of many texts, all texts stepped together.

    which: rows of scores for all words, text after text; starts: where each text begins, and the
    end. Texts are ordered by length, so that those still running are the first ones.
    """
    lengths = np.diff(starts)
    order = np.argsort(-lengths, kind="stable")
    begin, longest = starts[:-1][order], int(lengths.max(initial=0))
    running = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    # A word all of whose languages are excluded cannot be: known words have one, others zeros.
    floor = np.float32(-1e6)
    best = np.zeros((len(order), scores.shape[1]), dtype=np.float32)
    switched = np.zeros((len(which), scores.shape[1]), dtype=bool)
    leader = np.zeros(len(which), dtype=np.int16)
    for t in range(longest):
        n = running[t]
        at = begin[:n] + t
        own = np.maximum(scores[which[at]], floor)
        if t:
            lead = best[:n].argmax(axis=1)
            top = best[np.arange(n), lead][:, None] - penalty
            change = best[:n] < top
            switched[at], leader[at] = change, lead
            best[:n] = np.where(change, top, best[:n]) + own
        else:
            best[:n] = own
    labels = np.zeros(len(which), dtype=np.int16)
    now = best.argmax(axis=1).astype(np.int16)
    for t in range(longest - 1, -1, -1):
        n = running[t]
        at = begin[:n] + t
        labels[at] = now[:n]
        if t:
            now[:n] = np.where(switched[at, now[:n]], leader[at], now[:n])
    return labels


def label_words(texts: list[str | None], model: LanguageModel) -> tuple[list[list[str]], np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and for all words in a row: language, letters, and where texts begin.

    Words in a script no language was learned in are of none: they have the number after the last.
    """
    lists = [_words_of(t) if t else [] for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(w) for w in lists])]).astype(np.int64)
    words = [w for ws in lists for w in ws]
    if not words or not model.languages:
        return lists, np.zeros(len(words), np.int16), np.zeros(len(words), np.int64), starts
    distinct, which = _distinct(words)
    scores, letters = _word_scores(distinct, model)
    labels = _viterbi(scores, which, starts, model.rules.switch_penalty)
    known = model.scripts[_first_script(distinct)].any(axis=1)
    return lists, np.where(known[which], labels, len(model.languages)), letters[which], starts


def language_spans(text: str | None, model: LanguageModel) -> list[tuple[str, int, int]]:
    """Spans of one text: language or `und`, first word, word after the last; of cut words each piece counts."""
    _, labels, _, _ = label_words([text], model)
    cuts = np.flatnonzero(np.diff(labels)) + 1
    edges = [0, *cuts.tolist(), len(labels)]
    return [([*model.languages, UNKNOWN][labels[a]], a, b) for a, b in zip(edges, edges[1:]) if b > a and model.languages]


def _letters_by_language(texts: list[str | None], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Texts by languages, and one more for unknown scripts: letters in its spans; and each text's number of spans."""
    _, labels, letters, starts = label_words(texts, model)
    n, k = len(texts), len(model.languages) + 1
    text_of = np.repeat(np.arange(n), np.diff(starts))
    mass = np.bincount(text_of * k + labels, letters, minlength=n * k).reshape(n, k)
    change = (np.diff(labels) != 0) & (np.diff(text_of) == 0) if len(labels) else np.zeros(0, bool)
    return mass, np.bincount(text_of[1:][change], minlength=n) + (mass.sum(axis=1) > 0)


_PREDICTED = "doc_id long, lang_pred string, score double, n_spans int"


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, n_spans for every row of docs.

    Needs doc_id and text alone. score is the share of letters in spans of the language given;
    ties go to the first language by name. Letters in scripts no language was learned in count for none,
    so a text of such letters alone gets the first language by name with score 0. A null text, one without
    letters, and every text if no language was learned get `und` and score 0. Repeated rows give repeated rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for part in column_slices(batches, "text"):
            mass, spans = _letters_by_language(part.column("text").to_pylist(), own)
            total, mass = mass.sum(axis=1), np.pad(mass[:, :-1], ((0, 0), (0, not own.languages)))
            lead, known = mass.argmax(axis=1), (total > 0) & bool(own.languages)
            names = [own.languages[i] if ok else UNKNOWN for i, ok in zip(lead, known)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(names, pa.string()),
                 pa.array(mass.max(axis=1) / np.maximum(total, 1)), pa.array(spans, pa.int32())],
                names=["doc_id", "lang_pred", "score", "n_spans"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(run), _PREDICTED)


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = 0.5) -> DataFrame:
    """Rows of docs whose language is known and holds at least `least` of their letters, as they are.

    Letters in scripts no language was learned in count among all, but for no language; a text of
    several learned languages goes too if none holds its share. Needs text; a null text or one without
    letters goes, other columns may have any names. A model
    that knows no language rejects nothing.
    """
    if not model.languages:
        return docs
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for part in column_slices(batches, "text"):
            mass, _ = _letters_by_language(part.column("text").to_pylist(), own)
            total, most = mass.sum(axis=1), mass[:, :-1].max(axis=1)
            yield part.filter(pa.array((most > 0) & (most >= least * total)))

    return docs.mapInArrow(lean(run), docs.schema)
