"""The prefix trie against a brute-force version, over many partitions and odd rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rollcall.llm import prefix_trie

SCHEMA = "conv_id bigint, turn int, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_force(convs):
    """Nodes of {conv_id: [(role, text), ...]} by listing every prefix."""
    nodes = {}
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(conv)
    rows = set()
    for prefix, members in nodes.items():
        d = len(prefix)
        inside = [p for p in nodes if p[:d] == prefix]
        has_child = {p[:-1] for p in nodes if p}
        ends = sorted(c for c in members if len(convs[c]) == d)
        rows.add(
            (
                min(members),
                d,
                min(nodes[prefix[:-1]]) if d else None,
                len(members),
                sum(1 for p in nodes if p and p[:-1] == prefix),
                sum(1 for p in inside if p not in has_child),
                sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in inside if p),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return rows


def trie(spark, rows, partitions=None):
    turns = prefix_trie.conversation_turns(spark.createDataFrame(rows, SCHEMA))
    nodes = prefix_trie.prefix_nodes(prefix_trie.sequences(turns), partitions).select(*COLUMNS).collect()
    found = {tuple(r) for r in nodes}
    assert len(found) == len(nodes)
    return found


def rows_of(convs):
    return [(c, i, role, text) for c, turns in convs.items() for i, (role, text) in enumerate(turns)]


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_equals_brute_force_over_partitions(spark, partitions):
    draw = random.Random(partitions)
    convs = {}
    for c in range(1, 160):
        turns = [(draw.choice("ua"), draw.choice(["", "x", "yy"])) for _ in range(draw.choice([1, 2, 3, 4, 6]))]
        convs[c] = [("u", "common opening"), ("a", "é\U0001f600")][: draw.choice([0, 2, 2])] + turns
    convs |= {c: list(convs[3]) for c in range(200, 260)}
    assert trie(spark, rows_of(convs), partitions) == brute_force(convs)


def test_a_chain_through_every_partition(spark):
    convs = {c: [("u", "t")] * c for c in range(1, 40)}
    assert trie(spark, rows_of(convs), 25) == brute_force(convs)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "u", "a"), (1, 0, "u", "a"), (None, 0, "u", "a"), (-5, 3, "", ""), (-5, 4, "u", "a" * 200_000)]
    convs = {1: [("", ""), ("u", "a"), ("u", "a")], -5: [("", ""), ("u", "a" * 200_000)]}
    assert trie(spark, rows) == brute_force(convs)
    assert trie(spark, []) == set()


def test_shared_openings_and_turnless_conversations(spark):
    convs = {100: [("u", "a"), ("a", "b")], 101: [("u", "c"), ("a", "d"), ("u", "e")], 250: [("u", "z")]}
    turns = prefix_trie.conversation_turns(spark.createDataFrame(rows_of(convs), SCHEMA).withColumn("turns", F.lit(1)))
    conv = F.col("conv_id")
    shared = prefix_trie.with_shared_openings(turns, conv - conv % 100, F.lit(2), 5)
    rebuilt = {100: convs[100], 101: [("u", "a"), ("a", "b"), ("u", "e")], 250: []}
    nodes = prefix_trie.prefix_nodes(prefix_trie.sequences(shared), 3).select(*COLUMNS).collect()
    assert {tuple(r) for r in nodes} == brute_force(rebuilt)
    only = prefix_trie.with_shared_openings(turns.where("conv_id = 250"), F.lit(0), F.lit(2), 5)
    nodes = prefix_trie.prefix_nodes(prefix_trie.sequences(only)).select(*COLUMNS).collect()
    assert {tuple(r) for r in nodes} == brute_force({250: []})
