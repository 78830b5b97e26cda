"""Sharding by a Feistel permutation of global row numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import number_rows, text_or_empty
from rollcall.llm.feistel import permute

ROW_OVERHEAD = 16


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 16; null text: 16), text_crc32 and text_hash of each row."""
    text = text_or_empty()
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + ROW_OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )


def shard_rows(rows: DataFrame, n_shards: int, key: str, order: list[str]) -> DataFrame:
    """Each row with ``row_number``, ``position``, ``shard`` and ``slot``.

    Rows are numbered by ``order``; the keyed permutation gives each number a position; shard
    is the position modulo ``n_shards`` and slot what is left, so shard sizes differ by one at
    most, slots have no gaps, and where a row lies follows from its number alone.  Every column
    of ``rows`` is kept.  Null keys sort first.  Rows equal in every key of ``order`` share
    their numbers in any order.  An empty table gives an empty result.
    """
    numbered, total = number_rows(rows, [F.col(c) for c in order], "shard-rows")
    position = permute(F.col("row_number"), max(total, 1), key)
    return numbered.withColumn("position", position).withColumns(
        {
            "shard": (F.col("position") % n_shards).cast("int"),
            "slot": ((F.col("position") - F.col("position") % n_shards) / n_shards).cast("bigint"),
        }
    )
