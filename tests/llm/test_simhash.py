import random

import xxhash

from rollcall.llm import components, simhash
from rollcall.llm.components import connected_components


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in root:
        for b in root:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def clustered(seed):
    """Centres with many members a few bits apart, so that some cells are crowded."""
    rng = random.Random(seed)
    values = set()
    for size in (1, 1, 5, 120):
        centre = rng.getrandbits(64)
        for _ in range(size):
            value = centre
            for _ in range(rng.randint(0, 4)):
                value ^= 1 << rng.randrange(64)
            values.add(signed(value))
    return sorted(values)


def test_fingerprints_match_the_plain_form():
    texts = ["", " \t\n", "One", "one two", "A b c d\x0be", "The É of THE é of the", "x " * 500]
    for text in texts:
        assert simhash._fingerprint(text, 3) % (1 << 64) == plain_fingerprint(text)


def test_links_connect_what_brute_force_connects(spark):
    values = clustered(1)
    frame = spark.createDataFrame([(v,) for v in values], "bits bigint")
    expected = plain_components(values)
    for cell in (0, 4, 64):  # all cells crowded, some, none
        links = simhash.near_links(frame, cell)
        found = {r["node"]: r["root"] for r in connected_components(links).collect()}
        groups = {v: found.get(v, v) for v in values}
        assert {frozenset(k for k in groups if groups[k] == r) for r in groups.values()} == {
            frozenset(k for k in expected if expected[k] == r) for r in expected.values()
        }


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    found = connected_components(spark.createDataFrame(chain + star + [(7, 7), (3, 2)], "a bigint, b bigint"))
    assert {(r["node"], r["root"]) for r in found.collect()} == {(i, 0) for i in range(41)} | {(100 + i, 100) for i in range(30)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_groups_with_nulls_copies_and_clashing_columns(spark, docs):
    rows = [(5, "alpha beta gamma delta"), (3, "ALPHA beta gamma\tdelta"), (9, None), (4, ""), (None, " "), (5, "alpha beta gamma delta"), (8, "other text stands here alone")]
    found = simhash.near_duplicate_groups(docs(rows, bits=1, component_id=2, point=3)).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in found) == [(-1, 4), (3, 3), (4, 4), (5, 3), (5, 3), (8, 8), (9, 4)]
    kept = simhash.first_of_each_group(docs(rows, bits=1)).collect()
    assert sorted(r["doc_id"] or -1 for r in kept) == [3, 4, 8]
    assert simhash.near_duplicate_groups(docs([])).count() == 0


def test_rows_that_share_a_doc_id_or_have_none_are_judged_by_their_text(docs):
    same, other = "a b c d e f g", "totally different words stand here for once"
    def kept(rows):
        return sorted(((r["doc_id"], r["text"]) for r in simhash.first_of_each_group(docs(rows, bits=1, root=2)).collect()), key=str)

    assert kept([(5, same), (5, other), (3, same)]) == [(3, same), (5, other)]
    assert kept([(5, same), (5, other), (5, same)]) == [(5, same), (5, other)]
    assert kept([(None, same), (None, other), (None, same), (7, other)]) == [(7, other), (None, same)]
    assert kept([(None, None), (1, ""), (1, None)]) in ([(1, "")], [(1, None)])


def test_only_rows_not_told_apart_by_id_are_printed_again(docs):
    """One Python step for shared ids and one for null ones, each above what picks its rows."""
    kept = simhash.first_of_each_group(docs([(1, "a b c"), (1, "d e f"), (2, "g h i"), (None, "j k l")]))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2 and "isnotnull(pythonUDF" not in plan


def test_components_take_few_tasks_and_no_round_for_stars(spark):
    """What the driver keeps grows with the tasks it starts, and a shuffle starts as many as it has partitions."""
    context, partitions, before = spark.sparkContext, 20, {}
    tracker = context.statusTracker()
    for key, value in (("spark.sql.shuffle.partitions", partitions), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
        before[key] = spark.conf.get(key)
        spark.conf.set(key, value)

    def next_stage():
        context.setJobGroup("probe", "probe")
        context.parallelize([1], 1).count()
        context.setLocalProperty("spark.jobGroup.id", None)
        return max(s for j in tracker.getJobIdsForGroup("probe") for s in tracker.getJobInfo(j).stageIds)

    def shuffles(links):
        frame = spark.createDataFrame(links, "a bigint, b bigint").coalesce(1)
        first = next_stage()
        found = {(r["node"], r["root"]) for r in connected_components(frame).collect()}
        infos = [tracker.getStageInfo(s) for s in range(first + 1, next_stage())]
        return found, sum(i.numCompletedTasks for i in infos if i) / partitions

    try:
        star, of_star = shuffles([(100, 100 + i) for i in range(1, 30)])
        chain, of_chain = shuffles([(i, i + 1) for i in range(40)])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert star == {(100 + i, 100) for i in range(30)} and chain == {(i, 0) for i in range(41)}
    print("shuffles", of_star, of_chain)
    assert of_star < 6 and of_chain < 40


def test_components_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(components, "BROADCAST_ROWS", 0)
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1, k) for k in range(40, 80)]
    groups = {v: {v} for p in pairs for v in p}
    for a, b in pairs:
        joined = groups[a] | groups[b]
        for v in joined:
            groups[v] = joined
    found = connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    linked = {v for a, b in pairs if a != b for v in (a, b)}
    assert sorted((r["node"], r["root"]) for r in found) == sorted((v, min(groups[v])) for v in linked)
