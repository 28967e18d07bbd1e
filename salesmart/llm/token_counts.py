"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import shared, tokens

LIMIT = 2048


def count_tokens(
    docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every row's whole text.

    ``tokenizer`` is a file that every executor can open, ``.json`` or ``.model``. No row is
    moved: batches are cut by bytes, a text is cut where its tokenizer cuts it
    (:mod:`salesmart.llm.tokens`), and only lengths come back.

    A NULL text counts as empty: 0 bytes, 0 tokens. Repeated rows and keys, NULL keys included,
    each give a row. An empty table gives an empty one. Other columns are not read.
    """
    shared.bound_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                texts = [t or "" for t in part["text"].to_pylist()]
                n_tokens = pa.array(tokens.lengths(tokenizer, texts), pa.int64())
                n_bytes = pc.binary_length(part["text"]).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part["key"],
                        pc.fill_null(n_bytes, 0),
                        n_tokens,
                        pc.greater(n_tokens, limit),
                    ],
                    ["key", "n_bytes", "n_tokens", "over_limit"],
                )

    counted = rows.mapInArrow(
        count, f"key {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
    return counted.withColumnRenamed("key", key)
