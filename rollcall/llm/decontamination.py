"""Benchmark decontamination: SimHash windows of the items' sizes, multi-index Hamming blocks, exact check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import broadcast_if_small, free_name, staged, text_or_empty

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Fingerprint bits in which a window and an item may differ, and the blocks that find such pairs.
RADIUS = 14
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
BLOCK_RADIUS = RADIUS // len(BLOCKS)


def plain_words(text: Column) -> Column:
    """Lower-cased runs of letters, marks and digits, so that case and punctuation do not matter."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))


def _shingles(parts: Column, width: int) -> Column:
    """Hashes of the runs of ``width`` words, in order."""
    hashes = F.transform(
        parts, lambda w, i: F.xxhash64(w, *[F.get(parts, i + k) for k in range(1, width)])
    )
    return F.slice(hashes, 1, F.greatest(F.size(parts) - (width - 1), F.lit(0)))


def _fingerprint(hashes: Column) -> Column:
    """Bit b is 1 if over half the hashes, repeats included, have it."""

    def add(bits: Column, b: Column) -> Column:
        ones = F.size(F.filter(hashes, lambda h: F.call_function("getbit", h, b) == 1))
        majority = F.when(ones * 2 > F.size(hashes), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
        return bits.bitwiseOR(F.call_function("shiftleft", majority, b))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), add)


def _block(bits: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(bits, start).bitwiseAND(F.lit((1 << width) - 1))


def _near_values(value: Column, width: int) -> Column:
    """The value and those that differ from it in one bit or in two: ``BLOCK_RADIUS`` at most."""
    flips = [1 << i for i in range(width)]
    masks = [0, *flips, *[a | b for i, a in enumerate(flips) for b in flips[:i]]]
    return F.transform(F.array(*[F.lit(m).cast("bigint") for m in masks]), lambda m: value.bitwiseXOR(m))


def _needed(window: Column, item: Column) -> Column:
    """The least shingles in common at which two multisets of these sizes can be similar enough."""
    return F.ceil(SIMILARITY * (window + item) / (1 + SIMILARITY) - 1e-9).cast("int")


def _common(a: Column, b: Column) -> Column:
    """The size of the multiset intersection of two short arrays."""
    return F.aggregate(
        F.array_distinct(a),
        F.lit(0),
        lambda n, x: n + F.least(F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))),
    )


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, width, size, hashes, bits) of each item with a word.

    An item of fewer than five words is one shingle of all its words.
    """
    parts = benchmark.select("item_id", plain_words(text_or_empty()).alias("w")).where(F.size("w") > 0)
    by_width = [
        parts.where((F.size("w") == k) if k < SHINGLE_WORDS else (F.size("w") >= k)).select(
            "item_id", F.lit(k).alias("width"), _shingles(F.col("w"), k).alias("hashes")
        )
        for k in range(1, SHINGLE_WORDS + 1)
    ]
    items = by_width[0]
    for more in by_width[1:]:
        items = items.unionAll(more)
    return items.select("item_id", "width", F.size("hashes").alias("size"), "hashes", _fingerprint(F.col("hashes")).alias("bits"))


def _candidate_windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, width, size, wide, start) of the item-sized windows that could be similar to an item.

    A window can only be similar if so many of its shingles occur in items of its size that the
    intersection needed is reached; no other window needs a fingerprint.  Shingles of items are
    looked up by size, so the windows of a size meet the shingles of that size alone.
    """
    widths = [r[0] for r in items.select("width").distinct().collect()] or [SHINGLE_WORDS]  # five at most
    parts = docs.select("doc_id", plain_words(text_or_empty()).alias("w"))
    known = staged(
        items.select("width", "size", F.explode("hashes").alias("hash")).distinct(), "leak-known"
    )
    # The outer form of explode: for the other, Spark adds a filter on the array that is pushed
    # below and computes the words anew for every shingle.
    found = None
    for width in widths:
        hashed = parts.select("doc_id", _shingles(F.col("w"), width).alias("hashes"))
        spread = hashed.select("doc_id", F.size("hashes").alias("length"), F.posexplode_outer("hashes").alias("pos", "hash"))
        one = spread.join(broadcast_if_small(known.where(F.col("width") == width)), "hash")
        found = one if found is None else found.unionByName(one)
    places = found.groupBy("doc_id", "length", "width", "size").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    wide = F.least("length", "size")
    places = places.withColumn("wide", wide).withColumn("need", _needed(F.col("wide"), F.col("size")))
    # Any window with enough known shingles has its first and its `need`th of them inside it.
    first = F.transform(
        F.sequence(F.lit(0), F.size("at") - F.col("need")),
        lambda j: F.when(
            F.get("at", j + F.col("need") - 1) - F.get("at", j) < F.col("wide"),
            F.sequence(
                F.greatest(F.lit(0), F.get("at", j + F.col("need") - 1) - F.col("wide") + 1),
                F.least(F.get("at", j), F.col("length") - F.col("wide")),
            ),
        ).otherwise(F.array().cast("array<int>")),
    )
    windows = places.where(F.size("at") >= F.col("need")).select(
        "doc_id", "width", "size", "wide", F.explode_outer(F.array_distinct(F.flatten(first))).alias("start")
    ).where("start is not null")
    return windows


def leaked_windows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, hamming, similarity): each document's best window of an item.

    Every window as long as some item, at every word of every whole text, is compared with the
    items of its size (a text shorter than the item is one window).  Windows that cannot reach
    the similarity are left out before they are fingerprinted.  Items within ``RADIUS``
    fingerprint bits are found by blocks: five blocks and 14 bits leave a block with at most two
    differing bits, so items are listed under all block values up to two bits away and a window
    looks up its own five.  The weighted shingle similarity, sum of least over sum of greatest
    counts, decides: 0.8 or more.  Texts of one window are compared once however many documents
    hold it.  Null and empty texts and items without a word match nothing; a null doc_id is
    reported as null; repeated documents are reported once.
    """
    docs = docs.select("doc_id", "text")
    items = staged(benchmark_items(benchmark), "leak-items")
    windows = _candidate_windows(docs, items)
    by_doc = staged(
        windows.groupBy("doc_id").agg(F.collect_set(F.struct("width", "size", "wide", "start")).alias("windows")), "leak-windows"
    ).withColumnRenamed("doc_id", "_doc")
    held = docs.join(by_doc, docs["doc_id"].eqNullSafe(by_doc["_doc"])).withColumn("_w", plain_words(text_or_empty()))
    cut = held.select("doc_id", "_w", F.explode("windows").alias("v")).select(
        "doc_id", "v.*", F.slice("_w", F.col("v.start") + 1, F.col("v.wide") + F.col("v.width") - 1).alias("w")
    )
    hashed = None
    for width in range(1, SHINGLE_WORDS + 1):
        one = cut.where(F.col("width") == width).select(
            "doc_id", "width", "size", "start", _shingles(F.col("w"), width).alias("hashes")
        )
        hashed = one if hashed is None else hashed.unionAll(one)
    hashed = staged(hashed.withColumn("key", F.xxhash64("width", "size", "hashes")), "leak-hashed")
    distinct = hashed.groupBy("key", "width", "size").agg(F.first("hashes").alias("hashes"))
    printed = staged(distinct.withColumn("bits", _fingerprint(F.col("hashes"))), "leak-prints")
    probe = printed.select(
        "key", "width", "size", F.posexplode(F.array(*[_block(F.col("bits"), *b) for b in BLOCKS])).alias("block", "value")
    )
    listed = None
    for number, (start, width) in enumerate(BLOCKS):
        one = items.select(
            "item_id",
            "width",
            "size",
            F.lit(number).alias("block"),
            F.explode(_near_values(_block(F.col("bits"), start, width), width)).alias("value"),
        )
        listed = one if listed is None else listed.unionAll(one)
    met = probe.join(listed, ["width", "size", "block", "value"]).select("key", "item_id").distinct()
    wanted = items.select("item_id", F.col("hashes").alias("item_hashes"), F.col("bits").alias("item_bits"))
    pairs = met.join(printed.select("key", "hashes", "bits"), "key").join(wanted, "item_id")
    pairs = pairs.withColumn("hamming", F.bit_count(F.col("bits").bitwiseXOR(F.col("item_bits")))).where(
        F.col("hamming") <= RADIUS
    )
    common = _common(F.col("hashes"), F.col("item_hashes"))
    total = F.size("hashes") + F.size("item_hashes")
    scored = pairs.withColumn("common", common).withColumn("similarity", F.col("common") / (total - F.col("common")))
    similar = staged(
        scored.where(F.col("similarity") >= SIMILARITY).select("key", "item_id", "hamming", "similarity"), "leak-similar"
    )
    places = hashed.select("doc_id", "key", "start", (F.size("hashes") + F.col("width") - 1).alias("n_words"))
    best = F.max_by(
        F.struct(F.col("start").alias("start_word"), "n_words", "hamming", "similarity"),
        F.struct("similarity", -F.col("start")),
    )
    return (
        places.join(similar, "key").groupBy("doc_id", "item_id").agg(best.alias("_best")).select("doc_id", "item_id", "_best.*")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item.

    Rows whose doc_id is null or on several rows are judged one by one, by their own text.
    """

    def clean(rows: DataFrame, name: str) -> DataFrame:
        leaked = leaked_windows(rows.withColumn("doc_id", F.col(name)), benchmark)
        leaked = leaked.select(F.col("doc_id").alias("_leaked")).where("_leaked is not null").distinct()
        leaked = broadcast_if_small(staged(leaked, "leak-documents"))
        return rows.join(leaked, rows[name] == leaked["_leaked"], "left_anti")

    shared = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).count().where("count > 1").select("_id")
    shared = broadcast_if_small(staged(shared, "leak-shared"))
    unclear = docs.join(shared, docs["doc_id"] == shared["_id"], "left_semi").unionAll(docs.where("doc_id is null"))
    alone = docs.where("doc_id is not null").join(shared, docs["doc_id"] == shared["_id"], "left_anti")
    if not unclear.limit(1).count():
        return clean(alone, "doc_id")
    row = free_name(docs, "_row")
    unclear = staged(unclear.withColumn(row, F.monotonically_increasing_id()), "leak-unclear")
    return clean(alone, "doc_id").unionAll(clean(unclear, row).drop(row))
