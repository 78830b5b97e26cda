"""Embedding near-duplicates by spherical-cap filters with list-decoded random product codes.

A filter is a direction; a vector passes those whose inner product with it exceeds a threshold.
Vectors of a high cosine pass common filters, far ones almost never do.  The directions are a
product code: after a random rotation the coordinates are cut into blocks, each block has its own
random codewords, and every combination of one codeword a block is a direction.  There are more
directions than vectors, yet a vector finds all it exceeds without trying each: block by block,
partial sums are dropped once the best that the other blocks can add is not enough.  Several codes
with rotations of their own even out how many filters a vector passes.

Vectors that pass a common filter are compared in double precision, in blocks, and each pair
counts in the least filter that it shares.  Pairs are never sent: a block sends one count for
each vector and one link to the least vector it reaches there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import small_batches, staged
from rollcall.llm.components import connected_components

MIN_COSINE = 0.95
SEED = 20_240_613
#: Product codes, each after a rotation of its own; blocks of a code; least coordinates of a block.
CODES, BLOCKS, BLOCK_WIDTH = 10, 2, 8
#: Directions of a code for each distinct vector, and the most codewords of a block.
DIRECTIONS, MOST_CODEWORDS = 8, 1 << 16
#: Filters of one code that a random vector passes on average; sets the threshold.
PASSED = 4
#: Random vectors on which the threshold is found.
TRIED = 128
#: Members of a filter compared in one block.
BLOCK_ROWS = 2_048
#: Rows of the comparison done at once.
STRIP = 512
#: Members up to which filters are first tried together for any near pair.
SMALL_ROWS = 64


class ProductCode:
    """Directions for vectors of one dimension, the same wherever they are made."""

    def __init__(self, dim: int, vectors: int, number: int = 0, threshold: float | None = None):
        draw = np.random.default_rng([SEED, dim, number])
        blocks = max(1, min(BLOCKS, dim // BLOCK_WIDTH))
        count = int(np.clip(np.ceil((DIRECTIONS * max(vectors, 1)) ** (1 / blocks)), 2, MOST_CODEWORDS))
        self.rotation = np.linalg.qr(draw.standard_normal((dim, dim)))[0]
        self.cuts = np.array_split(np.arange(dim), blocks)
        self.words = []
        for cut in self.cuts:
            words = draw.standard_normal((count, len(cut)))
            self.words.append(np.unique(words / np.linalg.norm(words, axis=1, keepdims=True) / np.sqrt(blocks), axis=0))
        self.first = number * count**blocks
        self.threshold = threshold if threshold is not None else self._threshold(draw.standard_normal((TRIED, dim)))

    def _threshold(self, tried: np.ndarray) -> float:
        """The largest tried at which random vectors pass ``PASSED`` filters on average."""
        tried /= np.linalg.norm(tried, axis=1, keepdims=True)
        low, high, limit = 0.0, 1.0, PASSED * len(tried)
        for _ in range(12):
            self.threshold = (low + high) / 2
            passed, _ = self.decode(tried, 64 * limit)
            low, high = (self.threshold, high) if len(passed) >= limit else (low, self.threshold)
        return low

    def decode(self, units: np.ndarray, stop: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(vector, filter) for every filter that each unit vector exceeds; gives up beyond ``stop`` partial sums."""
        turned = units @ self.rotation
        scores = [turned[:, cut] @ words.T for cut, words in zip(self.cuts, self.words, strict=True)]
        best = [s.max(axis=1) for s in scores]
        rest = [sum(best[k + 1 :], np.zeros(len(units))) for k in range(len(scores))]
        owner, code, total = np.arange(len(units)), np.zeros(len(units), np.int64), np.zeros(len(units))
        for k, score in enumerate(scores):
            sums = total[:, None] + score[owner]
            at, word = np.nonzero(sums >= (self.threshold - rest[k][owner])[:, None])
            if stop is not None and len(at) > stop:
                return np.zeros(stop), np.zeros(stop, np.int64)
            total, code, owner = sums[at, word], code[at] * score.shape[1] + word, owner[at]
        return owner, code + self.first


def _units(packed, dim: int, kind: str) -> np.ndarray:
    """Rows of packed vectors as unit vectors in double precision."""
    rows = np.frombuffer(b"".join(packed), kind).reshape(-1, dim).astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _packed(kind: str):
    """Function of an array: its bytes, or null where it is null, zero, or holds null or no number."""

    def pack(vector) -> bytes | None:
        if vector is None or not len(vector):
            return None
        values = np.array(vector, "<f8")  # null components become NaN
        with np.errstate(over="ignore"):
            norm = np.linalg.norm(values)
        if not np.isfinite(values).all() or norm == 0 or not np.isfinite(norm):
            return None
        return (values + 0.0).astype(kind).tobytes()  # -0.0 becomes 0.0

    @F.pandas_udf(T.BinaryType())
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([pack(v) for v in batch], dtype=object)

    return packed


def product_codes(dim: int, vectors: int) -> list[ProductCode]:
    """All codes for vectors of one dimension, with one threshold."""
    first = ProductCode(dim, vectors)
    return [first, *(ProductCode(dim, vectors, k, first.threshold) for k in range(1, CODES))]


def _filters(kind: str, vectors: int):
    """Function of a packed vector: the filters it passes, in order."""
    size = np.dtype(kind).itemsize

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def filters(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codes = {}
        for batch in batches:
            out = np.empty(len(batch), object)
            dims = batch.str.len().to_numpy() // size
            for dim in np.unique(dims):
                if dim not in codes:
                    codes[dim] = product_codes(int(dim), vectors)
                places = np.flatnonzero(dims == dim)
                for at in range(0, len(places), STRIP):
                    rows = places[at : at + STRIP]
                    units = _units(batch.iloc[rows], int(dim), kind)
                    owner, found = (np.concatenate(x) for x in zip(*(code.decode(units) for code in codes[dim]), strict=True))
                    order = np.lexsort((found, owner))
                    for row, own in zip(rows, np.split(found[order], np.searchsorted(owner[order], np.arange(1, len(rows)))), strict=True):
                        out[row] = own
            yield pd.Series(out)

    return filters


def _groups(near: np.ndarray) -> np.ndarray:
    """The least index that each index reaches over ``near``, a symmetric matrix."""
    least = np.full(len(near), -1)
    for start in range(len(near)):
        if least[start] >= 0:
            continue
        front = np.array([start])
        while len(front):
            least[front] = start
            front = np.flatnonzero(near[front].any(axis=0) & (least < 0))
    return least


def _compare(units, sides, weights, lists, own_filter, min_cosine: float):
    """(counts, roots) of one block: linked copies of each vector, and the least vector it reaches."""
    n = len(units)
    near = np.zeros((n, n), bool)
    for at in range(0, n, STRIP):
        near[at : at + STRIP] = units[at : at + STRIP] @ units.T >= min_cosine
    near = near | near.T
    np.fill_diagonal(near, False)
    if sides.any():  # two blocks of one filter: only pairs across them, the others have blocks of their own
        near &= sides[:, None] != sides[None, :]
    if not near.any():
        return np.zeros(n, np.int64), np.arange(n)
    # A pair that shares a smaller filter has been counted there.
    at = np.repeat(np.arange(n), [len(x) for x in lists])
    smaller = np.concatenate(lists)
    at, smaller = at[smaller < own_filter], smaller[smaller < own_filter]
    _, name, times = np.unique(smaller, return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    several = times[name] > 1
    held = np.zeros((n, int((times > 1).sum())), np.float32)
    held[at[several], column[name[several]]] = 1
    counted = near.copy()
    for start in range(0, n, STRIP):
        counted[start : start + STRIP] &= held[start : start + STRIP] @ held.T == 0
    return counted @ weights, _groups(near)


def _worth_comparing(units: np.ndarray, starts: np.ndarray, min_cosine: float) -> np.ndarray:
    """For each run of rows from ``starts``, whether any two of it are near; large runs count as such.

    All small runs are tried at once: every row with the row k further on, for k below their size.
    """
    sizes = np.diff(np.append(starts, len(units)))
    worth = sizes > SMALL_ROWS
    run = np.repeat(np.arange(len(starts)), sizes)
    end = np.repeat(starts + sizes, sizes)
    rows = np.flatnonzero(~worth[run])
    for step in range(1, SMALL_ROWS):
        rows = rows[rows + step < end[rows]]
        if not len(rows):
            break
        near = np.einsum("ij,ij->i", units[rows], units[rows + step]) >= min_cosine - 1e-9
        worth[run[rows[near]]] = True
    return worth


def _compare_blocks(kind: str, min_cosine: float):
    """Streams sorted blocks; compares each as it is complete, the small ones of a batch together."""
    size = np.dtype(kind).itemsize

    def finish(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        place = rows[["dim", "filter", "pair"]].to_numpy()
        starts = np.concatenate(([0], np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1))
        dims, sizes = place[starts, 0], np.diff(np.append(starts, len(rows)))
        ids, copies, sides = (rows[c].to_numpy() for c in ("cid", "copies", "side"))
        packed, lists = rows["packed"].to_numpy(), rows["filters"].to_numpy()
        for dim in np.unique(dims):
            chosen = np.flatnonzero(dims == dim)
            at = np.concatenate([np.arange(starts[k], starts[k] + sizes[k]) for k in chosen])
            units = _units(packed[at], int(dim) // size, kind)
            inner = np.concatenate(([0], np.cumsum(sizes[chosen])[:-1]))
            for k in np.flatnonzero(_worth_comparing(units, inner, min_cosine)):
                own = slice(inner[k], inner[k] + sizes[chosen[k]])
                of = at[own]
                counts, roots = _compare(units[own], sides[of], copies[of], list(lists[of]), place[of[0], 1], min_cosine)
                linked = (counts > 0) | (roots != np.arange(len(of)))
                if linked.any():
                    yield pd.DataFrame({"cid": ids[of], "links": counts, "root": ids[of][roots]})[linked]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            place = batch[["dim", "filter", "pair"]].to_numpy()
            # The last block of a batch may go on in the next one.
            last = int(np.flatnonzero((place != place[-1]).any(axis=1))[-1]) + 1 if (place != place[-1]).any() else 0
            if held and (last or (held[-1][["dim", "filter", "pair"]].to_numpy()[-1] != place[0]).any()):
                done = finish(pd.concat([*held, batch.iloc[:last]]))
                held = []
            else:
                done = finish(batch.iloc[:last]) if last else iter(())
            out = list(done)
            if out:
                yield pd.concat(out)
            held.append(batch.iloc[last:])
        if held:
            yield from finish(pd.concat(held))

    return compare


def _blocks(shared: DataFrame, block_rows: int) -> DataFrame:
    """Members of each filter dealt to blocks of about ``block_rows``, and to each pair of blocks.

    A member of block i goes to the pairs of i and every block; ``side`` tells the larger one's.
    """
    parts = F.greatest(F.ceil(F.col("members") / block_rows), F.lit(1)).cast("bigint")
    dealt = shared.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("cid", "filter"), F.col("parts")))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    return other.withColumn("pair", low * F.col("parts") + high).withColumn("side", (F.col("part") > F.col("other")).cast("int"))


def near_duplicate_vectors(
    vectors: DataFrame, min_cosine: float = MIN_COSINE, vec_id: str = "vec_id", embedding: str = "embedding", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row.

    Vectors link at a cosine of ``min_cosine`` or more; those that are null, empty, zero, or hold
    null or non-finite components link with nothing, and vectors of different length never do.
    Equal vectors are one point with a number of copies, which link with each other.  Rows that
    repeat an id are vectors of their own.  A null id is kept and is never the least; where no
    row of a group has an id, component_id is null and kept is true.  Other columns are not
    looked at.  The filters find a link with high probability, measured in the tests; links they
    do not find are missing, no pair below ``min_cosine`` is linked.
    """
    spark = vectors.sparkSession
    double = vectors.schema[embedding].dataType.elementType == T.DoubleType()
    kind = "<f8" if double else "<f4"
    rows = vectors.select(F.col(vec_id).alias("vec_id"), _packed(kind)(F.col(embedding)).alias("packed"))
    with small_batches(spark):
        rows = staged(rows, "cap-rows")
        classes = rows.where("packed is not null").groupBy("packed").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
        classes = staged(classes.withColumn("cid", F.monotonically_increasing_id()), "cap-classes")
        passing = _filters(kind, classes.count())
        passed = staged(classes.select("cid", F.length("packed").alias("dim"), passing("packed").alias("filters")), "cap-filters")

        # Filters that one vector alone passes are left out, and vectors with no other filter.
        each = passed.select("cid", "dim", F.explode("filters").alias("filter"))
        crowds = each.groupBy("dim", "filter").agg(F.count("*").alias("members")).where("members > 1")
        shared = each.join(crowds, ["dim", "filter"])
        held = shared.groupBy("cid", "dim").agg(
            F.sort_array(F.collect_list("filter")).alias("filters"), F.collect_list(F.struct("filter", "members")).alias("of")
        )
        held = held.join(classes.select("cid", "copies", "packed"), "cid").withColumn("of", F.explode("of"))
        blocks = _blocks(held.select("*", "of.filter", "of.members").drop("of"), block_rows)
        place = ["dim", "filter", "pair"]
        sent = blocks.select(*place, "side", "cid", "copies", "filters", "packed")
        ordered = sent.repartition(*place).sortWithinPartitions(*place)
        found = staged(ordered.mapInPandas(_compare_blocks(kind, min_cosine), "cid long, links long, root long"), "cap-links")

    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    joined = classes.join(counts, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    joined = staged(joined.withColumn("root", F.coalesce("root", "cid")), "cap-joined")
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    points = joined.join(least, "root").select(
        "packed", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    alone = rows.where("packed is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = rows.where("packed is not null").join(points, "packed").select("vec_id", "n_links", "component_id")
    return linked.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
