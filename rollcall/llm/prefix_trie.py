"""Conversation prefix trie from sorted sequences: sparse-table range minima over their LCPs.

A conversation is a sequence of turns, each written as a fixed number of characters.  Distinct
sequences are range-partitioned and sorted; ``lcp[i]`` counts the turns that sequence i shares
with the one before it.  Sequence i starts the nodes of depth ``lcp[i] + 1`` to its length, and
each of these candidate prefixes finds the members to its left and right by binary search on a
sparse table of range minima, with no stack and no look at its neighbours' results.  So does the
prefix one turn shorter, which is its parent.

A partition has a table of its own.  A prefix that reaches the partition's end is continued by
prefixes of the first sequence of later partitions; these find the partition in which they start
by the same search on a table with one minimum per partition.  Only the prefixes of the first and
of the last sequence of each partition take part in that, and their pieces are summed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import broadcast_if_small, staged

#: Characters of a turn in a sequence: an MD5 and the text's code points, both in hex.
HASH_CHARS, TURN_CHARS = 32, 40
#: Members' ids are joined to texts of about so many characters before a class is hashed.
CHUNK_CHARS = 1 << 20
#: Candidates handed to Spark at once.
BATCH_NODES = 1 << 16
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

CHUNKS = "seq string, part int, chunk long, members long, least long, ids string"
VALUES = ("n_convs", "least", "n_leaves", "n_children", "saved")
CANDIDATES = (
    "part int, pos long, depth long, open boolean, edge boolean, chars long, ends string, n_convs long, least long,"
    " n_leaves long, n_children long, saved long, parent_open boolean, parent_edge boolean, parent_least long,"
    " lowest long, last_turns long, first_seq string, last_seq string"
)
NO_LIMIT = 1 << 40


def conversation_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as texts of ``TURN_CHARS``.

    Null turns come first; rows of one turn are ordered by role and then by text hash, and
    repeated rows stay repeated.  A null role or text is empty.  Rows without a conv_id belong to
    no conversation and are left out.  Other columns are not looked at.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    marked = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    code = F.concat(F.md5(marked.cast("binary")), F.lpad(F.lower(F.hex(F.length(text))), TURN_CHARS - HASH_CHARS, "0"))
    placed = F.struct(
        F.col("turn").isNotNull().alias("given"), F.coalesce("turn", F.lit(0)).alias("turn"), role.alias("role"), code.alias("code")
    )
    listed = turns.where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(placed)).alias("turns"))
    return listed.select("conv_id", F.col("turns.code").alias("turns"))


def with_shared_openings(turns: DataFrame, opening_of: Column, taken: Column, most: int) -> DataFrame:
    """Each conversation with its first ``taken`` turns (``most`` at most) replaced by another's.

    The other is the conversation whose id ``opening_of`` gives; it gives all its turns if it has
    fewer, and none if it does not exist.
    """
    openings = turns.select(F.col("conv_id").alias("_opening"), F.slice("turns", 1, most).alias("_turns"))
    joined = turns.withColumns({"_opening": opening_of, "_taken": taken.cast("int")}).join(openings, "_opening", "left")
    given = F.slice(F.coalesce("_turns", F.array().cast("array<string>")), F.lit(1), F.col("_taken"))
    rest = F.slice("turns", F.col("_taken") + 1, F.greatest(F.size("turns") - F.col("_taken"), F.lit(0)))
    return joined.select("conv_id", F.concat(given, rest).alias("turns"))


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, seq): the turns of ``conversation_turns`` as one text."""
    return turns.select("conv_id", F.array_join("turns", "").alias("seq"))


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of one sequence, in id order, as texts of joined ids."""
    part, names = TaskContext.get().partitionId(), [c.split()[0] for c in CHUNKS.split(", ")]
    current, ids, size, number, done = None, [], 0, 0, []

    def close() -> None:
        done.append((current, part, number, len(ids), ids[0], ",".join(map(str, ids))))

    for batch in batches:
        for seq, conv_id in zip(batch["seq"], batch["conv_id"].tolist(), strict=True):
            if ids and (seq != current or size >= CHUNK_CHARS):
                close()
                number, ids, size = number + 1, [], 0
            current = seq
            ids.append(conv_id)
            size += 20
        if done:
            yield pd.DataFrame(done, columns=names)
            done.clear()
    if ids:
        close()
        yield pd.DataFrame(done, columns=names)


def shared_turns(a: str, b: str) -> int:
    """How many turns two sequences share at their start."""
    low, high = 0, min(len(a), len(b)) // TURN_CHARS
    while low < high:
        middle = (low + high + 1) // 2
        cut = slice(low * TURN_CHARS, middle * TURN_CHARS)
        low, high = (middle, high) if a[cut] == b[cut] else (low, middle - 1)
    return low


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Level k holds the minima of all runs of 2**k values."""
    table = [values]
    while 2 ** len(table) <= len(values):
        width = 2 ** (len(table) - 1)
        table.append(np.minimum(table[-1][:-width], table[-1][width:]))
    return table


def reach_right(lcp: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last sequence that shares ``depth`` turns with the one ``at``, by binary search."""
    at, n = at.copy(), len(lcp[0])
    for k in reversed(range(len(lcp))):
        inside = at + 2**k < n
        at[inside & (lcp[k][np.where(inside, at + 1, 0)] >= depth)] += 2**k
    return at


def reach_left(lcp: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first sequence that shares ``depth`` turns with the one ``at``, by binary search."""
    at = at.copy()
    for k in reversed(range(len(lcp))):
        inside = at >= 2**k
        at[inside & (lcp[k][np.where(inside, at - 2**k + 1, 0)] >= depth)] -= 2**k
    return at


def _range_min(table: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = np.empty(len(left), np.int64)
    level = np.frexp((right - left + 1).astype(float))[1] - 1
    for k in np.unique(level):
        of = level == k
        out[of] = np.minimum(table[k][left[of]], table[k][right[of] - 2**k + 1])
    return out


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All prefixes that a sequence of this partition starts, with what they cover within it.

    The first sequence counts as sharing nothing with the partition before; ``edge`` marks the
    candidates that may change by that, or that reach the partition's end (``open``).  A row of
    depth 0 has the digest of the turnless conversations, one of depth -1 the partition's figures.
    """
    lengths, lcps, members, leasts, ends, chars = [], [], [], [], [], []
    current, first, digest = None, None, None
    for batch in batches:
        for seq, n, least, ids in zip(batch["seq"], batch["members"].tolist(), batch["least"].tolist(), batch["ids"], strict=True):
            if seq == current:
                digest.update(b"," + ids.encode())
                members[-1] += n
                continue
            if digest:
                ends.append(digest.hexdigest())
            shared = shared_turns(current, seq) if current is not None else 0
            first = seq if current is None else first
            current, digest = seq, hashlib.sha256(ids.encode())
            lengths.append(len(seq) // TURN_CHARS)
            lcps.append(shared)
            members.append(n)
            leasts.append(least)
            chars.extend(
                int(seq[d * TURN_CHARS + HASH_CHARS : (d + 1) * TURN_CHARS], 16) for d in range(shared, lengths[-1])
            )
    if digest is None:
        return
    ends.append(digest.hexdigest())
    part, m = TaskContext.get().partitionId(), len(lengths)
    length, lcp, weight, least = (np.array(x, np.int64) for x in (lengths, lcps, members, leasts))
    columns = [c.split()[0] for c in CANDIDATES.split(",")]
    totals = {
        "part": part,
        "depth": -1,
        "n_convs": int(weight.sum()),
        "least": int(least.min()),
        "lowest": int(lcp[1:].min(initial=NO_LIMIT)),
        "last_turns": int(length[-1]),
        "first_seq": first,
        "last_seq": current,
    }
    tops = [totals] + ([{"part": part, "depth": 0, "ends": ends[0]}] if length[0] == 0 else [])
    for top in tops:
        yield pd.DataFrame({name: [top.get(name)] for name in columns})

    started = length - lcp
    stops = np.cumsum(started)
    row = np.repeat(np.arange(m), started)
    depth = np.arange(len(row)) - np.repeat(stops - started, started) + lcp[row] + 1
    chars = np.array(chars, np.int64)
    table, leasts_table = sparse_table(lcp), sparse_table(least)
    left, right = reach_left(table, row, depth), reach_right(table, row, depth)
    up_left, up_right = reach_left(table, row, depth - 1), reach_right(table, row, depth - 1)

    def total(values: np.ndarray) -> np.ndarray:
        upto = np.concatenate(([0], np.cumsum(values)))
        return upto[right + 1] - upto[left]

    is_leaf = (np.append(lcp[1:], -1) < length) & (length > 0)
    places = np.sort(lcp * m + np.arange(m))
    branches = np.searchsorted(places, depth * m + right, "right") - np.searchsorted(places, depth * m + left, "right")
    n_convs, is_open = total(weight), right == m - 1
    edge, up_edge = is_open | (row == 0), (up_right == m - 1) | (up_left == 0)
    saved = np.concatenate(([0], np.cumsum(np.where(edge, 0, (n_convs - 1) * chars))))
    out = {
        "pos": row,
        "depth": depth,
        "open": is_open,
        "edge": edge,
        "chars": chars,
        "n_convs": n_convs,
        "least": _range_min(leasts_table, left, right),
        "n_leaves": total(is_leaf.astype(np.int64)),
        "n_children": branches + (length[row] > depth),
        "saved": saved[stops[right]] - saved[:-1],
        "parent_open": up_right == m - 1,
        "parent_edge": up_edge & (depth > 1),
        "parent_least": _range_min(leasts_table, up_left, up_right),
    }
    ends = np.array(ends, object)
    for at in range(0, len(row), BATCH_NODES):
        cut = slice(at, at + BATCH_NODES)
        batch = {name: values[cut] for name, values in out.items()}
        batch["part"] = part
        batch["ends"] = np.where(depth[cut] == length[row[cut]], ends[row[cut]], None)
        yield pd.DataFrame({name: batch.get(name) for name in columns}, index=range(len(row[cut])))


@F.pandas_udf(T.LongType())
def _shared_turns(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([shared_turns(x, y) if x is not None and y is not None else 0 for x, y in zip(a, b, strict=True)])


def _starts_in(lowest: list[int], parts: list[int]):
    """Function of a partition and a depth: where the prefix that opens the partition starts."""

    @F.pandas_udf(T.LongType())
    def start(part: pd.Series, depth: pd.Series) -> pd.Series:
        table, known = sparse_table(np.array(lowest, np.int64)), np.array(parts, np.int64)
        at = np.maximum(np.searchsorted(known, part.to_numpy()) - 1, 0)  # it shares with the one before
        return pd.Series(known[reach_left(table, at, depth.to_numpy())])

    return start


def _edge_nodes(candidates: DataFrame, bounds: list[tuple]) -> DataFrame:
    """Candidates at a partition's edges with the totals of the prefix they are a piece of.

    A piece that is no start (``carried``) has the totals of the start's node; ``total_saved`` is
    right in the rows of starts.  One row for each (part, depth, open).
    """
    spark = candidates.sparkSession
    known = spark.createDataFrame(bounds, "part int, shared long, lowest long, covered int")
    start = _starts_in([b[2] for b in bounds], [b[0] for b in bounds])
    carried = (F.col("pos") == 0) & (F.col("depth") <= F.col("shared"))
    pieces = candidates.where("edge and depth > 0").join(F.broadcast(known.drop("lowest")), "part").withColumns(
        {
            "carried": carried,
            "n_leaves": F.col("n_leaves") - F.when(F.col("open"), F.col("covered")).otherwise(0),
            "n_children": F.col("n_children") - ((F.col("pos") == 0) & (F.col("depth") < F.col("shared"))).cast("int"),
            "start_part": F.when(carried, start(F.col("part"), F.col("depth"))).otherwise(F.col("part")),
            "start_open": carried | F.col("open"),
        }
    )
    pieces = staged(pieces, "trie-pieces")
    key = ["start_part", "start_open", "depth"]
    sums = [(F.min if c == "least" else F.sum)(c).alias(f"total_{c}") for c in VALUES]
    pieces = pieces.join(pieces.groupBy(*key).agg(*sums), key)
    own = F.when(F.col("carried"), 0).otherwise((F.col("total_n_convs") - 1) * F.col("chars"))
    deeper = Window.partitionBy("part").orderBy(F.desc("depth")).rangeBetween(Window.unboundedPreceding, 0)
    at_end = F.sum(F.when(F.col("open"), own).otherwise(0)).over(deeper)
    at_start = F.sum(F.when(~F.col("open"), own).otherwise(0)).over(deeper)
    below = F.when(F.col("open"), at_end).otherwise(0) + F.when(F.col("pos") == 0, at_start).otherwise(0)
    pieces = staged(pieces.withColumn("below", below), "trie-edges")
    below = pieces.groupBy(*key).agg(F.sum("below").alias("total_below"))
    return pieces.join(below, key).withColumn("total_saved", F.col("total_saved") + F.col("total_below"))


def prefix_nodes(seqs: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row for each distinct prefix of (conv_id, seq), one conv_id a row; no conversation: no rows.

    conv_id, the smallest member; depth; parent_conv_id; n_convs; n_children; n_leaves;
    saved_tokens; ends_sha256.  Equal conversations meet as runs of joined ids, so a sequence
    that a third of all share is split over partitions until its digest, which reads these texts
    one by one.  A partition holds whole sequences; one conversation is never split, so its turns
    (40 bytes each) must fit a task.  ``partitions`` fixes the number of range partitions.
    """
    number = [] if partitions is None else [partitions]
    members = seqs.repartitionByRange(*number, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    chunks = members.mapInPandas(_chunks, CHUNKS)
    ordered = chunks.repartitionByRange(*number, "seq").sortWithinPartitions("seq", "part", "chunk")
    candidates = staged(ordered.mapInPandas(_candidates, CANDIDATES), "trie-candidates")

    by_part = Window.orderBy("part")  # one row for each partition
    figures = candidates.where("depth = -1").withColumn("before", F.lag("last_seq").over(by_part))
    figures = figures.select("part", _shared_turns("first_seq", "before").alias("shared"), "lowest", "last_turns", "n_convs", "least")
    figures = figures.orderBy("part").collect()
    followed = [f["shared"] for f in figures[1:]] + [-1] * bool(figures)
    bounds = [
        (f["part"], f["shared"], min(f["shared"], f["lowest"]), int(0 < f["last_turns"] == after))
        for f, after in zip(figures, followed, strict=True)
    ]
    edges = staged(_edge_nodes(candidates, bounds), "trie-resolved")

    kept = ["part", "depth", "ends", "parent_open", "parent_edge", "parent_least"]
    nodes = candidates.where("not edge and depth > 0").select(*kept, *VALUES)
    nodes = nodes.unionByName(edges.where("not carried").select(*kept, *[F.col(f"total_{c}").alias(c) for c in VALUES]))
    parents = edges.select("part", (F.col("depth") + 1).alias("depth"), F.col("open").alias("parent_open"), F.col("total_least").alias("found"))
    at_edge = nodes.where("parent_edge").join(broadcast_if_small(parents), ["part", "depth", "parent_open"], "left")
    nodes = nodes.where("not parent_edge").withColumn("found", F.col("parent_least")).unionByName(at_edge)
    everyone = min((f["least"] for f in figures), default=None)
    nodes = nodes.select(
        F.col("least").alias("conv_id"),
        "depth",
        F.when(F.col("depth") == 1, F.lit(everyone).cast("bigint")).otherwise(F.col("found")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
    turnless = candidates.where("depth = 0").agg(F.max("ends").alias("ends"))
    top = nodes.where("depth = 1").agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    root = top.join(F.broadcast(turnless)).select(
        F.lit(everyone).cast("bigint").alias("conv_id"),
        F.lit(0).cast("bigint").alias("depth"),
        F.lit(None).cast("bigint").alias("parent_conv_id"),
        F.lit(sum(f["n_convs"] for f in figures)).cast("bigint").alias("n_convs"),
        "n_children",
        F.coalesce("n_leaves", F.lit(1)).cast("bigint").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("bigint").alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
    return nodes.unionByName(root.where(F.lit(bool(figures))))
