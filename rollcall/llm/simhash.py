"""SimHash near-duplicates by segment popcounts: a grid range-join bounds distances, bits decide.

A 64-bit fingerprint is cut into 32 segments of two bits.  The popcounts of the segments (0, 1
or 2) are a point on a grid, and the Manhattan distance of two points is never more than the
Hamming distance of the fingerprints.  Two fingerprints at most two bits apart lie at most one
step apart in the upper or in the lower 16 segments, so cells of half the segments are joined
with themselves and with the cells one step further.  Points are kept in unary form (1 as 01,
2 as 11), in which the Manhattan distance is a bit count and a step up sets one bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import broadcast_if_small, free_name, small_batches, staged, text_or_empty
from rollcall.llm.components import connected_components

SHINGLE_WORDS = 3
HASH_SEED = 42
MOST_BITS = 2
LOW_BITS = 0x5555555555555555
#: Members of a cell up to which each is compared with every point that probes the cell.
PAIRED_CELL = 64


def _fingerprint(text: str, size: int) -> int:
    """Majority bits of the hashes of all shingles, as a signed 64-bit integer."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    line, width = memoryview(b" ".join(parts)), min(size, len(parts))
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(parts) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], HASH_SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[at : at + (1 << 16)], dtype="<u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


@F.pandas_udf(T.LongType())
def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """SimHash of whole texts over three-word shingles, A-Z lowered; no word: 0.

    ``bytes.lower`` and ``bytes.split`` lower A-Z alone and split at space and tab to carriage
    return alone.
    """
    for batch in texts:
        yield pd.Series([_fingerprint(t, SHINGLE_WORDS) for t in batch], dtype="int64")


def unary_popcounts(bits: Column) -> Column:
    """The popcounts of 32 two-bit segments, each in unary in its own two bits."""
    high = F.shiftrightunsigned(bits, 1)
    either = bits.bitwiseOR(high).bitwiseAND(F.lit(LOW_BITS))
    both = F.shiftleft(bits.bitwiseAND(high).bitwiseAND(F.lit(LOW_BITS)), 1)
    return either.bitwiseOR(both)


def _half(point: Column, half: int) -> Column:
    mask = F.lit(0xFFFFFFFF)
    return point.bitwiseAND(mask) if half == 0 else F.shiftrightunsigned(point, 32).bitwiseAND(mask)


def _steps_up(cell: Column) -> Column:
    """The cell and the at most 16 cells in which one segment counts one more."""

    def next_bit(segment: Column) -> Column:
        shift = (segment * 2).cast("int")
        value = F.call_function("shiftright", cell, shift).bitwiseAND(F.lit(3))
        bit = F.when(value == 0, F.lit(1)).when(value == 1, F.lit(2)).otherwise(F.lit(0)).cast("bigint")
        return cell.bitwiseOR(F.call_function("shiftleft", bit, shift))

    stepped = F.transform(F.sequence(F.lit(0), F.lit(15)), next_bit)
    return F.array_distinct(F.concat(F.array(cell), stepped))


def _spread(points: DataFrame, cells) -> DataFrame:
    """(half, cell, bits, point) with one row for each cell that ``cells`` gives."""
    sides = [
        points.select(
            F.lit(h).alias("half"), F.explode(cells(_half(F.col("point"), h))).alias("cell"), "bits", "point"
        )
        for h in (0, 1)
    ]
    return sides[0].unionAll(sides[1])


def near_links(fingerprints: DataFrame, paired_cell: int = PAIRED_CELL) -> DataFrame:
    """(a, b): links that connect all distinct ``bits`` (bigint) at most two bits apart.

    In a cell of at most ``paired_cell`` members every member meets every prober; pairs whose
    Manhattan distance is over two are dropped before bits are compared.  A fuller cell would
    give the square of its size, so those who live in it or probe it are linked through shared
    neighbours instead: each is listed under itself and under its 64 one-bit neighbours, and
    those on one list, at most 65, are linked to the least of them.  Two fingerprints at most
    two bits apart always share a list, and those on one list are at most two bits apart, so
    both ways connect the same fingerprints.
    """
    points = staged(
        fingerprints.select("bits").distinct().withColumn("point", unary_popcounts(F.col("bits"))), "simhash-points"
    )
    homes = _spread(points, lambda cell: F.array(cell))
    probes = _spread(points, _steps_up)
    sizes = homes.groupBy("half", "cell").agg(F.count("*").alias("members"))
    full = sizes.where(F.col("members") > paired_cell).select("half", "cell")
    hosts = homes.join(full, ["half", "cell"], "left_anti").select(
        "half", "cell", F.col("bits").alias("host"), F.col("point").alias("host_point")
    )
    hosts = hosts.unionByName(
        full.select("half", "cell", F.lit(None).cast("bigint").alias("host"), F.lit(None).cast("bigint").alias("host_point"))
    )
    met = probes.join(hosts, ["half", "cell"]).where(
        F.col("host").isNull()
        | (
            (F.col("host") != F.col("bits"))
            & (F.bit_count(F.col("point").bitwiseXOR(F.col("host_point"))) <= MOST_BITS)
            & (F.bit_count(F.col("bits").bitwiseXOR(F.col("host"))) <= MOST_BITS)
        )
    )
    met = staged(met.select(F.col("bits").alias("a"), F.col("host").alias("b")).distinct(), "simhash-met")
    paired = met.where(F.col("b").isNotNull())
    crowded = met.where(F.col("b").isNull()).select("a").distinct()
    flips = F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda i: F.col("a").bitwiseXOR(F.call_function("shiftleft", F.expr("1L"), i)),
    )
    listed = crowded.select("a", F.explode(F.concat(F.array("a"), flips)).alias("shared"))
    least = listed.groupBy("shared").agg(F.min("a").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return paired.unionByName(listed.join(least, "shared").select("a", "b").distinct()).where("a != b")


def _grouped(docs: DataFrame, paired_cell: int) -> DataFrame:
    """(doc_id, bits, root, component_id) for each row; root is a fingerprint that names the group."""
    with small_batches(docs.sparkSession):
        prints = staged(docs.select("doc_id", fingerprint(text_or_empty()).alias("bits")), "simhash-prints")
    firsts = staged(prints.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "simhash-firsts")
    roots = connected_components(near_links(firsts, paired_cell))
    rooted = firsts.join(roots.select(F.col("node").alias("bits"), "root"), "bits", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "bits"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = rooted.join(least, "root").select("bits", "root", "component_id")
    return prints.join(groups, "bits").select("doc_id", "bits", "root", "component_id")


def near_duplicate_groups(docs: DataFrame, paired_cell: int = PAIRED_CELL) -> DataFrame:
    """(doc_id, bits, component_id) for each row; component_id is the least doc_id of the group.

    Texts link at most two fingerprint bits apart, and a group is all that links reach.  A null
    or empty text, or one of white space, has fingerprint 0 and links like any other.  Rows with
    one text share a fingerprint and meet as one point, so copies are never paired.  Repeated
    rows stay repeated; a null doc_id is kept and is never the least; a group of null doc_ids
    alone has a null component_id.  Columns other than doc_id and text are not looked at.
    """
    return _grouped(docs, paired_cell).select("doc_id", "bits", "component_id")


def first_of_each_group(docs: DataFrame) -> DataFrame:
    """The documents that stay: of each near-duplicate group, the row with the least doc_id.

    All columns of ``docs`` are kept.  Rows without a doc_id go where their group has a named
    row; of a group without any, one row stays.  Where the least doc_id is on several rows of a
    group, one of them stays; rows of other groups that share a doc_id are judged by their own
    group.
    """
    groups = staged(_grouped(docs, PAIRED_CELL), "simhash-groups")
    named = groups.where("doc_id is not null")
    dropped = named.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_id")).distinct()
    dropped = broadcast_if_small(staged(dropped, "simhash-dropped"))
    # Only rows whose doc_id does not tell them apart are looked at by their text.
    shared = named.groupBy(F.col("doc_id").alias("_id")).count().where("count > 1")
    shared = broadcast_if_small(staged(shared.select("_id"), "simhash-shared"))
    alone = docs.where("doc_id is not null").join(shared, docs["doc_id"] == shared["_id"], "left_anti")
    alone = alone.join(dropped, alone["doc_id"] == dropped["_id"], "left_anti")
    together = docs.join(shared, docs["doc_id"] == shared["_id"], "left_semi").unionAll(docs.where("doc_id is null"))
    firsts = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    printed, root = free_name(docs, "_print"), free_name(docs, "_root")
    firsts = firsts.select(F.col("doc_id").alias("_id"), F.col("bits").alias("_bits"), F.col("root").alias(root)).distinct()
    together = together.withColumn(printed, fingerprint(text_or_empty()))
    # With == Spark would filter on non-null prints first: of all rows, in Python, twice in a task.
    met = together["doc_id"].eqNullSafe(firsts["_id"]) & together[printed].eqNullSafe(firsts["_bits"])
    together = together.join(firsts, met)
    return alone.unionAll(together.dropDuplicates([root]).select(*[together[c] for c in docs.columns]))
