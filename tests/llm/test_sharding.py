import zlib
from collections import Counter

from pyspark.sql import functions as F

from rollcall.llm import sharding
from rollcall.llm.feistel import permute


def test_the_permutation_is_one_to_one_and_keyed(spark):
    for n in (1, 2, 3, 10, 97, 1000):
        both = spark.range(n).select(permute(F.col("id"), n, "a").alias("a"), permute(F.col("id"), n, "b").alias("b")).collect()
        assert sorted(r["a"] for r in both) == list(range(n)) == sorted(r["b"] for r in both)
    assert [r["a"] for r in both] != [r["b"] for r in both]
    assert sum(r["a"] == i for i, r in enumerate(both)) < 20


def test_shards_differ_by_one_and_slots_have_no_gaps(docs):
    rows = [(i, "x" * (i % 7)) for i in range(200)] + [(None, None), (None, "é"), (3, "xxx")]
    order = ["doc_id", "size", "text_crc32", "text_hash"]
    placed = sharding.shard_rows(sharding.document_sizes(docs(rows)), 7, "k", order).collect()
    counts = Counter(r["shard"] for r in placed)
    assert len(placed) == len(rows) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in placed if r["shard"] == shard) == list(range(n))
    sizes = {(r["doc_id"], r["size"], r["text_crc32"]) for r in placed}
    assert sizes == {(i, 16 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t in rows}
    again = sharding.shard_rows(sharding.document_sizes(docs(rows[::-1])), 7, "k", order).collect()
    assert {tuple(r) for r in placed} == {tuple(r) for r in again}


def test_an_empty_table_has_no_shards(docs):
    assert sharding.shard_rows(sharding.document_sizes(docs([])), 3, "k", ["doc_id"]).count() == 0
