"""SentencePiece encoding with the place of every piece in the original bytes, and decoding.

A text is normalised first: at each place the longest source string of the model's compiled
character map that begins there is replaced, other characters stay. Beside the normalised bytes
runs an array with the source offset of each, so a piece, which is a stretch of normalised bytes,
projects to a stretch of the original by two look-ups.

Pieces of the normalised text are the library's, from the same model with its own normalisation
taken out; how many normalised bytes a piece takes is known from its id.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import column_slices, ship_package

# The mark that stands for a blank, kinds of pieces, and fields of a model file.
BLANK = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_PIECE, _TRAINER, _NORMALIZER = 1, 2, 3
# A normaliser that changes nothing, as a field of a model: no map, no blank in front, no trimming.
_BARE = bytes([_NORMALIZER << 3 | 2, 6, 2 << 3 | 2, 0, 3 << 3, 0, 4 << 3, 0])

_ENCODED = "doc_id long, ids array<int>, begins array<int>, ends array<int>"


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = varint() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
        yield key >> 3, data[at : at + size]
        at += size


def character_map(blob: bytes) -> dict[str, str]:
    """The rules of a compiled character map: a double-array trie, then the targets it points to."""
    if not blob:
        return {}
    size = struct.unpack_from("<I", blob)[0]
    units, targets = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64), blob[4 + size :]

    def base(unit: np.ndarray) -> np.ndarray:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    rules, sources, nodes, letters = {}, [b""], base(units[:1]), np.arange(1, 256)
    while len(nodes):
        places = nodes[:, None] ^ letters
        # A unit belongs to the node whose label it carries; the top bit marks values.
        own = (places < len(units)) & (units[np.minimum(places, len(units) - 1)] & 0x800000FF == letters)
        parent, letter = np.nonzero(own)
        places = places[own]
        sources = [sources[p] + bytes([b]) for p, b in zip(parent.tolist(), letters[letter].tolist())]
        nodes = places ^ base(units[places])
        for i in np.flatnonzero(units[places] >> 8 & 1).tolist():
            begin = int(units[nodes[i]]) & 0x7FFFFFFF
            rules[sources[i].decode()] = targets[begin : targets.index(0, begin)].decode()
    return rules


class PieceModel:
    """A model file made ready in the task that uses it."""

    def __init__(self, data: bytes):
        from sentencepiece import SentencePieceProcessor

        kinds, pieces, settings = [], [], {}
        for number, value in _fields(data):
            if number == _PIECE:
                # Defaults of the format: an empty string, a normal piece.
                own = {1: b"", 3: _NORMAL} | dict(_fields(value))
                kinds.append(own[3])
                pieces.append(own[1].decode())
            elif number in (_TRAINER, _NORMALIZER):
                settings.setdefault(number, {}).update(_fields(value))
        trainer, normalizer = settings[_TRAINER], settings[_NORMALIZER]
        # Fixed numbers of settings: byte fallback, blanks as suffix; unknown surface, rules, prefix, trim, marks.
        if not trainer.get(35) or trainer.get(24) or not set(kinds) <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("only models with byte fallback and without own symbols are supported")
        unknown = trainer.get(44, " \u2047 ".encode())
        self.rules = character_map(normalizer.get(2, b""))
        self.prefix, self.trim, marks = (bool(normalizer.get(n, 1)) for n in (3, 4, 5))
        if not marks:
            raise ValueError("only models that mark blanks are supported")
        # A later message replaces settings of an earlier one.
        self.library = SentencePieceProcessor(model_proto=data + _BARE)
        self.reach: dict[str, int] = {}
        for source in self.rules:
            self.reach[source[0]] = max(self.reach.get(source[0], 0), len(source))
        self.starts = re.compile("[" + "".join(map(re.escape, sorted(self.reach))) + "]") if self.rules else None
        by_kind = {_UNKNOWN: lambda p: unknown, _CONTROL: lambda p: b"", _BYTE: lambda p: bytes([int(p[3:5], 16)])}
        plain = lambda p: p.replace(BLANK, " ").encode()
        self.spoken = [by_kind.get(k, plain)(p) for k, p in zip(kinds, pieces)]
        self.blank = [p == BLANK for p in pieces]
        self.leads = [k == _NORMAL and p.startswith(BLANK) for k, p in zip(kinds, pieces)]
        # Normalised bytes of a piece; of a byte piece its own.
        self.sizes = np.array([1 if k == _BYTE else len(p.encode()) for k, p in zip(kinds, pieces)], np.int32)
        self.byte_of = np.array([int(p[3:5], 16) if k == _BYTE else -1 for k, p in zip(kinds, pieces)], np.int16)

    def _unit(self, text: str, at: int) -> tuple[str, int]:
        """What stands for the longest source string at a place, and the length of that string."""
        for size in range(self.reach.get(text[at], 0), 0, -1):
            target = self.rules.get(text[at : at + size])
            if target is not None:
                return target, size
        return text[at], 1

    def _mapped(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Bytes after the longest-prefix rules, and the source offset each comes from."""
        source = np.frombuffer(text.encode(), np.uint8)
        if not self.starts:
            return source, np.arange(len(source), dtype=np.int32)
        out, origin, at, offset = [], [], 0, 0

        def keep(upto: int) -> None:
            nonlocal offset
            own = text[at:upto].encode()
            out.append(np.frombuffer(own, np.uint8))
            origin.append(np.arange(offset, offset + len(own), dtype=np.int32))
            offset += len(own)

        while found := self.starts.search(text, at):
            keep(found.start())
            at = found.start()
            target, size = self._unit(text, at)
            own = target.encode()
            out.append(np.frombuffer(own, np.uint8))
            origin.append(np.full(len(own), offset, dtype=np.int32))
            offset += len(text[at : at + size].encode())
            at += size
        keep(len(text))
        return np.concatenate(out), np.concatenate(origin)

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and the source offset of each and of their end."""
        at = 0
        while self.trim and at < len(text) and (unit := self._unit(text, at))[0] == " ":
            at += unit[1]
        if at == len(text):
            return b"", np.zeros(1, np.int32)
        # The blank put in front stands where the first unit that is no blank begins.
        first, end = len(text[:at].encode()), len(text.encode())
        out, origin = self._mapped(text)
        if self.trim:
            blank = out == 32
            extra = blank & np.concatenate([[True], blank[:-1]])[: len(out)]
            out, origin = out[~extra], origin[~extra]
        origin = np.concatenate([np.repeat(origin, np.where(out == 32, 3, 1)), [end]]).astype(np.int32)
        marked = out.tobytes().replace(b" ", BLANK.encode())
        if self.prefix:
            marked = BLANK.encode() + marked
            origin = np.concatenate([np.full(3, first, np.int32), origin])
        if self.trim:
            marked = marked.decode().rstrip(BLANK).encode()
        return marked, origin[: len(marked) + 1]

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the first byte and the end of each in the text; a null text is an empty one.

        A character without a piece becomes one id per byte, of which the last takes all of its span.
        """
        normal, origin = self.normalise(text or "")
        ids = np.asarray(self.library.encode(normal.decode(), out_type="numpy"), np.int32)
        ends = np.cumsum(self.sizes[ids], dtype=np.int64)
        begins = ends - self.sizes[ids]
        byte = self.byte_of[ids]
        if (byte >= 0).any():
            first = (byte < 0) | (byte < 0x80) | (byte >= 0xC0)
            begins = begins[np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0))]
            ends = np.where(np.append(first[1:], True), ends, begins)
        return ids, origin[begins], origin[ends]

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the blank put before a text goes, and a byte that makes no character is U+FFFD."""
        said = b"".join(map(self.spoken.__getitem__, ids))
        if self.prefix or self.trim:
            for i in ids:
                if self.leads[i]:
                    said = said[1:]
                if self.spoken[i] and not (self.trim and self.blank[i]):
                    break
        return said.decode("utf-8", "each_byte")


codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


@lru_cache(maxsize=2)
def _ready(data: bytes) -> PieceModel:
    return PieceModel(data)


def _arrays(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def _model(df: DataFrame, path: str):
    """The model file, read where the driver runs and sent with the tasks."""
    ship_package(df.sparkSession)
    with open(path, "rb") as f:
        data = f.read()
    PieceModel(data)
    return df.sparkSession.sparkContext.broadcast(data)


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids, begins, ends for every row of docs: each piece with its span of UTF-8 bytes of the text.

    Needs doc_id and text; other columns are left out. A null, empty or (if the model trims) blank text
    has no ids. Texts are encoded whole; repeated rows give repeated rows, an empty table an empty one.
    """
    shared = _model(docs, model_path)

    def run(batches):
        model = _ready(shared.value)
        for part in column_slices(batches, "text"):
            made = [model.encode(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *[_arrays([m[k] for m in made]) for k in range(3)]],
                names=["doc_id", "ids", "begins", "ends"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ENCODED)


def decode_documents(encoded: DataFrame, model_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """The table with the text that its ids spell; null ids give an empty text."""
    shared = _model(encoded, model_path)
    kept = encoded.drop(text)
    schema = f"{kept._jdf.schema().toDDL()}, `{text}` string"

    def run(batches):
        model = _ready(shared.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            flat, offsets = column.values.to_numpy(), column.offsets.to_pylist()
            known = column.is_valid().to_pylist()
            said = [model.decode(flat[a:b].tolist() if ok else []) for a, b, ok in zip(offsets, offsets[1:], known)]
            texts = pa.array(said, pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, text])

    return kept.mapInArrow(run, schema)


_DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"


def piece_digest(docs: DataFrame, model_path: str) -> DataFrame:
    """Per row of docs: number of ids, SHA-256 of the decimal ids joined by commas and of the text decoded from
    them, and bytes of the text that their spans cover.

    Encodes and decodes in one pass, so that the ids of a document never leave its task.
    """
    shared = _model(docs, model_path)

    def run(batches):
        model = _ready(shared.value)
        names = [str(i) for i in range(len(model.spoken))]
        for part in column_slices(batches, "text"):
            rows = []
            for text in part.column("text").to_pylist():
                ids, begins, ends = model.encode(text)
                ids = ids.tolist()
                shown = ",".join([names[i] for i in ids]).encode()
                covered = int(np.maximum(ends - begins, 0).sum())
                said = model.decode(ids).encode()
                rows.append((len(ids), hashlib.sha256(shown).hexdigest(), hashlib.sha256(said).hexdigest(), covered))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _DIGEST)
