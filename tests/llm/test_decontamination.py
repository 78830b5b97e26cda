import random
import re
from collections import Counter

import xxhash

from rollcall.llm import decontamination as D


def shingles(words, width):
    out = []
    for i in range(len(words) - width + 1):
        seed = 42
        for w in words[i : i + width]:
            seed = xxhash.xxh64_intdigest(w.encode(), seed)
        out.append(seed)
    return out


def bits(hashes):
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain(rows, items):
    found = {}
    for doc, text in rows:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        for item, item_text in items:
            own = re.findall(r"[^\W_]+", (item_text or "").lower())
            if not own:
                continue
            width = min(5, len(own))
            target = shingles(own, width)
            every = shingles(words, width)
            wide = min(len(target), len(every))
            for start in range(len(every) - wide + 1) if wide else ():
                window = every[start : start + wide]
                a, b = Counter(window), Counter(target)
                similarity = sum((a & b).values()) / sum((a | b).values())
                if similarity >= 0.8 and bin(bits(window) ^ bits(target)).count("1") <= D.RADIUS:
                    found[doc, item] = max(found.get((doc, item), 0), similarity)
    return found


def test_leaks_match_brute_force(spark, docs):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(say(rng.choice((12, 20, 20, 31))))) for i in range(12)]
    items += [(50, "Two words"), (51, "lone"), (52, None), (53, "!!"), (54, items[3][1])]
    rows = []
    for i in range(40):
        part = items[i % 12][1].split()
        if i % 3 == 1:
            part[rng.randrange(len(part))] = "changed"
        if i % 4 == 2:
            part = [w.upper() + "," for w in part]
        rows.append((i, " ".join(say(rng.randint(0, 60)) + part + say(rng.randint(0, 60)))))
    rows += [(100, None), (101, ""), (102, "clean words w1 w2 w3"), (103, "here two words stand"), (104, items[2][1][: len(items[2][1]) - 3]), (7, rows[7][1])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = D.leaked_windows(docs(rows, size=1, width=2, key=3, item_id=4), benchmark).collect()
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in found}
    assert got == {k: round(v, 9) for k, v in plain(rows, items).items()}
    assert len(found) == len(got)
    kept = {r["doc_id"] for r in D.without_leaks(docs([*rows, (None, items[0][1])]), benchmark).collect()}
    assert kept == {r[0] for r in rows} - {d for d, _ in got}


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    assert D.leaked_windows(docs([]), some).count() == 0
    assert D.leaked_windows(docs([(1, "a b c d e f")]), none).count() == 0
    assert D.leaked_windows(docs([(1, "a b c d e f")]), some).count() == 1


def test_rows_that_share_a_doc_id_or_have_none_are_judged_by_their_text(spark, docs):
    item = " ".join(f"item{i}" for i in range(20))
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    rows = [(1, f"x y {item} z"), (1, "clean text of one"), (None, item), (None, "clean text"), (2, item), (3, "clean")]
    kept = D.without_leaks(docs(rows, _row=1), benchmark)
    assert sorted(str(r["text"]) for r in kept.collect()) == ["clean", "clean text", "clean text of one"]
    assert kept.columns == docs(rows, _row=1).columns
