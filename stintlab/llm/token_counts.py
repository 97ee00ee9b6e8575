"""Number of tokens per document, by the whole-token shortcut.

Which strings of the vocabulary are one token when they stand alone is proved once, before the
job. A pre-token equal to one of them counts as 1 by a look-up; only the rest is merged.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import column_slices, ship_package
from stintlab.llm.vocab import WordCounter, load_file, whole_token_words

_COUNTED = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit for every row of docs.

    Needs doc_id and text; other columns are left out. A null or empty text has no bytes and no
    tokens. Texts are counted whole; repeated rows give repeated rows, an empty table an empty one.
    """
    spark = docs.sparkSession
    ship_package(spark)
    source = load_file(tokenizer_path)
    shared = spark.sparkContext.broadcast((source, whole_token_words(source)))

    def run(batches):
        counter = WordCounter(*shared.value)
        for part in column_slices(batches, "text"):
            texts = part.column("text").to_pylist()
            sizes = [len(t.encode()) if t else 0 for t in texts]
            counts = list(map(counter.count, texts))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([n > limit for n in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _COUNTED)
