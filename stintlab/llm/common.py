"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlab.sources.shipping import give_back, lean, ship_package
from stintlab.sources.tables import stage

__all__ = ["column_slices", "crc_fold", "give_back", "hash_share", "kept_by_marks", "lean", "read", "row_key", "ship_package", "stage"]

# Text handled at once inside a task.
CHUNK_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_fold(key: Column, folds: int) -> Column:
    """crc32 of a key written as text, modulo a number of folds; null for a null key."""
    return F.crc32(key.cast("string")) % folds


def hash_share(key: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by a key. Rows below a threshold are a sample of any partitioning."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 40)) / F.lit(float(1 << 40))


def row_key(*columns: str) -> Column:
    """64 bits for the content of some columns, nulls told apart from empty values."""
    return F.xxhash64(*[c for name in columns for c in (F.col(name), F.col(name).isNull())])


def column_slices(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the text in each holds about limit bytes, one row at least."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        start, size = 0, 0
        lengths = pa.compute.binary_length(column).to_pylist()
        for i, n in enumerate(lengths):
            size += n or 0
            if size >= limit:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def kept_by_marks(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows whose hash in a long column is in wanted, and few others: a filter before a join.

    The wanted hashes are marked in a bitmap of bounded size, so that rows are not shuffled.
    """
    bits = 1 << max(15, min(28, math.ceil(math.log2(max(2, 16 * wanted.count())))))
    place = F.pmod(F.col(column), F.lit(bits)) + 1  # Spark's bitmaps number bits from 1
    parts = (
        wanted.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap")).collect()
    )
    marks = np.zeros(bits // 8, dtype=np.uint8)
    for r in parts:
        at = (r["bucket"] - 1) * 4096
        own = np.frombuffer(bytes(r["bitmap"]), dtype=np.uint8)[: bits // 8 - at]
        marks[at : at + len(own)] = own
    shared = rows.sparkSession.sparkContext.broadcast(marks)

    def run(batches):
        own = shared.value
        for batch in batches:
            p = batch.column(batch.schema.get_field_index(column)).to_numpy(zero_copy_only=False) & (8 * len(own) - 1)
            yield batch.filter(pa.array((own[p >> 3] >> (p & 7).astype(np.uint8)) & 1 > 0))

    return rows.mapInArrow(lean(run), rows.schema)
