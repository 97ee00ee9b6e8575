"""Token ids in compressed blocks, each document on its own under one shared dictionary.

A zstandard dictionary is trained on serialized id arrays, so that even short documents, which are
compressed one by one, shrink. A written folder holds

    dictionary/  one row: sha256 and bytes of the dictionary
    blocks/      shard, block, first_token, dict_sha256, doc_ids, n_tokens, offsets, frames

Rows of a block are consecutive documents in ascending doc_id order; `frames` are their compressed
ids end to end and `offsets` where each begins, one more for the end. first_token is the number of
ids before the block in its shard. A document is read by its block's doc_id range and one slice.
Blocks are rows of a Parquet table: Spark commits them, so a task that runs again leaves no trace,
and any storage Spark can write will do.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stintlab.llm.common import column_slices, hash_share, lean, ship_package
from stintlab.llm.vocab import byte_encoder, load_file
from stintlab.sources.tables import staged_dir

# Text encoded at once inside a task: the arrays over its bytes and words take some twenty times as much.
ENCODED_BYTES = 1 << 20


@dataclass(frozen=True)
class OutputRules:
    """sample_docs: documents the dictionary is trained on, drawn by hash; it changes sizes, not ids."""

    end_id: int = 2
    dictionary_bytes: int = 64 << 10
    sample_docs: int = 1000
    sample_bytes: int = 32 << 10
    level: int = 3
    block_docs: int = 256
    block_bytes: int = 4 << 20


_BLOCKS = (
    "shard int, block int, first_token long, dict_sha256 string, doc_ids array<long>, "
    "n_tokens array<long>, offsets array<long>, frames binary"
)


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """Bytes of a trained dictionary; too few samples give their own bytes as the dictionary."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw) if raw else None


def _sampled_ids(docs: DataFrame, shared, rules: OutputRules) -> list[bytes]:
    share = min(1.0, rules.sample_docs / max(1, docs.count()))

    def run(batches):
        encoder = byte_encoder(shared.value)
        for part in column_slices(batches, "text", ENCODED_BYTES):
            ids = encoder.encode_all(part.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array([x[: rules.sample_bytes] for x in ids], pa.binary())], names=["ids"])

    drawn = docs.filter(hash_share(F.col("doc_id"), 3) < share).select("text")
    return sorted(bytes(r["ids"]) for r in drawn.mapInArrow(lean(run, byte_encoder), "ids binary").collect() if r["ids"])


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, rules: OutputRules = OutputRules()) -> None:
    """Encode every whole text and write the folder described above.

    Needs doc_id and text; other columns are left out. A null text is an empty one and holds the end
    id alone. Rows with equal doc_id are ordered by a hash of their text, null ids come first. An
    empty table gives a folder without blocks.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(load_file(tokenizer_path))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train_dictionary(_sampled_ids(narrow, shared, rules), rules.dictionary_bytes)
    sha = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(sha, bytearray(dictionary))], "dict_sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    sent = spark.sparkContext.broadcast(dictionary)
    end = np.array([rules.end_id], dtype="<u4").tobytes()

    def run(batches):
        import zstandard
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        encoder = byte_encoder(shared.value)
        squeeze = zstandard.ZstdCompressor(level=rules.level, dict_data=_dictionary(sent.value)).compress
        block, before = 0, 0
        ids: list[int | None] = []
        counts: list[int] = []
        frames: list[bytes] = []

        def done():
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])])
            row = [shard, block, before, sha, ids, counts, offsets.tolist(), b"".join(frames)]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int64()),
                                                       pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()))],
                names=["shard", "block", "first_token", "dict_sha256", "doc_ids", "n_tokens", "offsets", "frames"],
            )

        size = 0
        for part in column_slices(batches, "text", ENCODED_BYTES):
            for doc, raw in zip(part.column("doc_id").to_pylist(), encoder.encode_all(part.column("text"))):
                raw += end
                frame = squeeze(raw)
                ids.append(doc)
                counts.append(len(raw) // 4)
                frames.append(frame)
                size += len(frame)
                if len(ids) >= rules.block_docs or size >= rules.block_bytes:
                    yield done()
                    block, before = block + 1, before + sum(counts)
                    ids, counts, frames, size = [], [], [], 0
        if ids:
            yield done()

    order = ["doc_id", F.xxhash64("text")]
    (
        narrow.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(lean(run, byte_encoder), _BLOCKS).write.parquet(f"{path}/blocks")
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian uint32 bytes)."""
    ship_package(spark)
    kept = spark.read.parquet(f"{path}/dictionary").first()
    sha, dictionary = kept["dict_sha256"], bytes(kept["dictionary"])
    sent = spark.sparkContext.broadcast(dictionary)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    tokens = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b)
    # One row per written shard, as many as the job had tasks.
    shards = blocks.groupBy("shard").agg(F.sum(tokens).alias("shard_tokens"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("shard_tokens").over(earlier), F.lit(0)).alias("shard_start"))

    def run(batches):
        import zstandard

        expand = zstandard.ZstdDecompressor(dict_data=_dictionary(sent.value)).decompress
        for batch in batches:
            for i in range(batch.num_rows):
                # One block at a time becomes Python objects.
                row = batch.slice(i, 1).to_pylist()[0]
                if row["dict_sha256"] != sha:
                    raise ValueError("block written under another dictionary")
                frames, offsets = memoryview(row["frames"]), row["offsets"]
                ids = [expand(frames[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
                counts = np.array(row["n_tokens"], dtype=np.int64)
                if [len(x) // 4 for x in ids] != row["n_tokens"]:
                    raise ValueError("block and its index differ")
                start = row["shard_start"] + row["first_token"] + np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(start, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    placed = blocks.join(F.broadcast(starts), "shard")
    return placed.mapInArrow(lean(run, byte_encoder), "doc_id long, start long, n_tokens long, ids binary")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """Ids of the documents with that id, from the slices their blocks' offset indexes name."""
    import zstandard

    kept = spark.read.parquet(f"{path}/dictionary").first()
    expand = zstandard.ZstdDecompressor(dict_data=_dictionary(bytes(kept["dictionary"]))).decompress
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").filter(F.array_contains("doc_ids", doc_id))
    at = F.expr("arrays_zip(doc_ids, slice(offsets, 1, size(doc_ids)), slice(offsets, 2, size(doc_ids)))")
    found = blocks.select("shard", "block", "frames", F.posexplode(at).alias("nth", "x")).filter(F.col("x.doc_ids") == doc_id)
    picked = found.select("shard", "block", "nth", F.expr("substring(frames, cast(x.`1` + 1 as int), cast(x.`2` - x.`1` as int))").alias("frame")).orderBy("shard", "block", "nth")
    return [np.frombuffer(expand(bytes(r["frame"])), dtype="<u4") for r in picked.collect()]


def token_digest(docs: DataFrame, tokenizer_path: str, path: str | None = None, rules: OutputRules = OutputRules()) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 as read back from what was written to path.

    Without a path the folder is one of the session's staged tables.
    """
    spark = docs.sparkSession
    path = path or f"{staged_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer_path, rules)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
