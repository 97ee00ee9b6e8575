"""Tokenizer files applied with a cache of pre-tokens, giving what the library gives.

A pre-token is encoded on its own, so its ids depend on nothing around it. Each task splits texts
itself and keeps what the library's model makes of each pre-token it has met. Texts for which that
is not plainly the same (special strings, characters beyond Latin-1, whose classes two regular
expression engines might see differently) go to the library whole.

Byte-level ids are made for many texts at once: numpy finds where pre-tokens begin, Arrow numbers the
distinct ones, and the model merges the new ones in strings of many, parted by a letter that no merge
holds.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

from stintlab.sources.shipping import kept_in_worker

# Pre-tokens kept by an encoder; beyond it the cache, or the part of it that is full, starts anew.
CACHE_WORDS = 400_000
# Longer pre-tokens are encoded but not kept.
_LONGEST_KEPT = 64
# New pre-tokens merged in one string.
_MERGED_AT_ONCE = 200

# Letters, numbers and blanks of Latin-1.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t-\r \x85\xa0"


def load_file(path: str) -> str:
    """The tokenizer file as text, read where the driver runs, to be sent with the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


class _Kept(dict):
    """What was made of each pre-token, made when first asked for."""

    def __init__(self, make: Callable, known: dict):
        super().__init__(known)
        self.make = make

    def __missing__(self, word: str):
        made = self.make(word)
        if len(word) <= _LONGEST_KEPT:
            self[word] = made
        return made


class _Tokenizer:
    """A library tokenizer made in the task that uses it."""

    SPLIT = ""
    known: dict = {}

    def __init__(self, source: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_str(source)
        self.special = [t["content"] for t in json.loads(source)["added_tokens"]]
        self.split = re.compile(self.SPLIT).findall
        self.model = self.library.model
        # The letters that stand for the bytes of Latin-1 text in the vocabulary.
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = {b: x for c in range(256) for b, x in zip(chr(c).encode(), spell(chr(c))[0][0])}
        self._restart()

    def _restart(self) -> None:
        self.kept = _Kept(self._make, self.known)

    def _make(self, word: str):
        raise NotImplementedError

    def _merge(self, word: str) -> list:
        return self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _simple(self, text: str) -> bool:
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return False
        return not any(s in text for s in self.special)

    def _look_up(self):
        if len(self.kept) > CACHE_WORDS:
            self._restart()
        return self.kept.__getitem__


class ByteEncoder(_Tokenizer):
    """Byte-level BPE: ids of texts as little-endian unsigned 32-bit integers."""

    # Fixed value: the split of the byte-level tokenizer, which _starts follows.
    SPLIT = (
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
    )

    def __init__(self, source: str):
        super().__init__(source)
        # Of each Latin-1 character: 1 letter, 2 number, 3 blank, 0 any other.
        self.classes = np.array(
            [next((k for k, x in ((1, _L), (2, _N), (3, _S)) if re.fullmatch(f"[{x}]", chr(c))), 0) for c in range(256)], dtype="u1"
        )
        self.apart = self._inert_letter(json.loads(source)["model"])
        self.spelled = np.zeros(256, dtype="<u4")
        for b, x in self.letters.items():
            self.spelled[b] = ord(x)
        if self.apart:
            self.spelled[0xFF] = ord(self.apart)  # no byte of UTF-8

    def _inert_letter(self, model: dict) -> str | None:
        """A letter of the vocabulary that no Latin-1 text has and no merge holds; None if merges are not all there is."""
        from tokenizers.pre_tokenizers import ByteLevel

        rules = ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")
        if model["type"] != "BPE" or any(model.get(k) for k in rules):
            return None
        merged = set("".join("".join(m) for m in model["merges"])) | set(self.letters.values())
        return min((x for x in ByteLevel.alphabet() if x in model["vocab"] and x not in merged), default=None)

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _make(self, word: str) -> bytes:
        return self._bytes([t.id for t in self._merge(word)])

    def _make_all(self, words: list[str]) -> list[bytes]:
        if not self.apart:
            return list(map(self._make, words))
        made, end = [], self.model.token_to_id(self.apart)
        for at in range(0, len(words), _MERGED_AT_ONCE):
            joined = b"".join([w.encode() + b"\xff" for w in words[at : at + _MERGED_AT_ONCE]])
            letters = self.spelled[np.frombuffer(joined, dtype="u1")].tobytes().decode("utf-32-le")
            ids = np.array([t.id for t in self.model.tokenize(letters)], dtype="<u4")
            raw, ends = ids.tobytes(), np.flatnonzero(ids == end) * 4
            made += [raw[a:b] for a, b in zip([0, *(ends[:-1] + 4).tolist()], ends.tolist())]
        return made

    def _starts(self, data: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Bytes at which pre-tokens begin, in the UTF-8 of Latin-1 texts end to end; firsts: where each text begins."""
        n = len(data)
        kind = self.classes[data]
        wide = np.flatnonzero(data >= 0xC2)
        kind[wide] = kind[wide + 1] = self.classes[((data[wide] & 3) << 6) | (data[wide + 1] & 0x3F)]
        first = np.zeros(n + 1, dtype=bool)
        first[firsts] = first[n] = True
        start = first.copy()
        start[1:n] |= kind[1:] != kind[:-1]
        # The last blank of a run is apart from those before it; a space goes with what follows.
        after = np.flatnonzero((kind[1:] != 3) & (kind[:-1] == 3) & ~first[1:n]) + 1
        start[after - 1 - (data[after - 1] >= 0x80)] = True
        start[after[data[after - 1] == 0x20]] = False
        # 's and its like, where a pre-token begins with the apostrophe.
        quote = np.flatnonzero((data == 0x27) & start[:n])
        padded = np.concatenate([data, np.zeros(2, dtype="u1")])
        one, two = padded[quote + 1], padded[quote + 2]
        inside = ~first[quote + 1]
        short = inside & np.isin(one, np.frombuffer(b"stmd", dtype="u1"))
        long = inside & ~first[np.minimum(quote + 2, n)] & (
            ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((two == ord("l")) & (one == ord("l")))
        )
        start[quote[short | long] + 1] = False
        start[quote[short] + 2] = start[quote[long] + 3] = True
        return np.flatnonzero(start[:n])

    def _restart(self) -> None:
        # Pre-tokens met in one call so far, and those met again in a later one.
        self.kept, self.often = {}, {}

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct pre-tokens."""
        found = list(map(self.often.get, words))
        other = [w for w, x in zip(words, found) if x is None]
        known = list(map(self.kept.get, other))
        new = [w for w, x in zip(other, known) if x is None]
        made = self._make_all(new)
        rest = iter(made)
        known_or_made = iter([next(rest) if x is None else x for x in known])
        again = {w: x for w, x in zip(other, known) if x is not None}
        if len(self.often) + len(again) > CACHE_WORDS * 3 // 4:
            self.often = {w: x for w, x in zip(words, found) if x is not None}
        self.often.update(again)
        for w in again:
            del self.kept[w]
        if len(self.kept) + len(new) > CACHE_WORDS // 4:
            self.kept = {}
        self.kept.update(zip(new, made))
        for w in [w for w in new if len(w) > _LONGEST_KEPT]:
            del self.kept[w]
        return [next(known_or_made) if x is None else x for x in found]

    def _encode_simple(self, texts: pa.Array) -> list[bytes]:
        """Texts of Latin-1 characters without special strings, none of them null."""
        texts = texts.cast(pa.large_string())
        bounds = np.frombuffer(texts.buffers()[1], dtype="i8")[texts.offset : texts.offset + len(texts) + 1]
        if not len(texts) or bounds[0] == bounds[-1]:
            return [b""] * len(texts)
        data = np.frombuffer(texts.buffers()[2], dtype="u1")[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        starts = self._starts(data, bounds[:-1])
        edges = pa.py_buffer(np.append(starts, len(data)))
        words = pa.LargeStringArray.from_buffers(len(starts), edges, pa.py_buffer(data)).dictionary_encode()
        found = self._ids_of(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        # All ids end to end, from those of the distinct words.
        pool, sizes = np.frombuffer(b"".join(found), dtype="<u4"), np.fromiter(map(len, found), dtype="i8", count=len(found)) // 4
        which = words.indices.to_numpy()
        ends = np.cumsum(sizes[which])
        cuts = np.append(0, ends)[np.searchsorted(starts, bounds)]
        # From place in all ids to place in the pool: the same distance for all ids of a word.
        at = np.repeat(np.cumsum(sizes)[which] - ends, sizes[which])
        at += np.arange(len(at))
        ids = pool[at]
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text; a null text is an empty one."""
        texts = texts.fill_null("")
        plain = [self._simple(t) for t in texts.to_pylist()]
        if all(plain):
            return self._encode_simple(texts)
        simple = pa.array(plain)
        made = iter(self._encode_simple(texts.filter(simple)))
        whole = iter(texts.filter(pa.compute.invert(simple)).to_pylist())
        return [next(made) if p else self._bytes(self.whole(next(whole))) for p in plain]

    def encode(self, text: str | None) -> bytes:
        """A null text is an empty one."""
        return self.encode_all(pa.array([text], pa.string()))[0]


@kept_in_worker(maxsize=1)
def byte_encoder(source: str) -> ByteEncoder:
    """The encoder of a worker process, with what earlier tasks of the process have met; the last file's only."""
    return ByteEncoder(source)


class WordCounter(_Tokenizer):
    """Lower-cased BPE with word ends: number of tokens of texts."""

    # The split of the word tokenizer, and the mark of a token that ends a word.
    SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+"
    END = "</w>"

    def __init__(self, source: str, singles: frozenset[str]):
        self.known = dict.fromkeys(singles, 1)
        super().__init__(source)

    def _make(self, word: str) -> int:
        return len(self._merge(word))

    def count(self, text: str | None) -> int:
        """A null text has none. Latin-1 text is composed already, so lower case is all it needs."""
        if not text:
            return 0
        if not self._simple(text):
            return len(self.whole(text))
        return sum(map(self._look_up(), self.split(text.lower())))


def whole_token_words(source: str) -> frozenset[str]:
    """Strings of the vocabulary that are one pre-token and one token when they stand alone.

    Each is proved by encoding it: the library must give exactly that one id back.
    """
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    library, decoder = Tokenizer.from_str(source), ByteLevel()
    names = [(decoder.decode([w.removesuffix(WordCounter.END)]), i)
             for w, i in library.get_vocab().items() if w.endswith(WordCounter.END)]
    alone = [(w, i) for w, i in names if w.lower() == w and re.fullmatch(WordCounter.SPLIT, w)]
    encoded = library.encode_batch([w for w, _ in alone], add_special_tokens=False)
    return frozenset(w for (w, i), e in zip(alone, encoded) if e.ids == [i])
