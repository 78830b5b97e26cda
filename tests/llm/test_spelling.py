"""Spelling variants against brute force, with and without crowded chunks."""

import random
import zlib
from collections import Counter

import pytest

from rollcall.llm import spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_force(counts):
    near = {w: [o for o in counts if one_edit(w, o)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, n, form[w], counts.get(form[w]), len(near[w]), root))
    return rows


def forms(spark, counts, crowded):
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    return {tuple(r) for r in spelling.spelling_forms(df, crowded).select("word", "n", "form", "form_n", "n_near", "root").collect()}


@pytest.mark.parametrize("crowded", [0, 50, 10**9])
def test_equals_brute_force(spark, crowded):
    draw = random.Random(7)
    words = {"".join(draw.choice("abé") for _ in range(draw.choice([5, 6, 7, 8]))) for _ in range(260)}
    counts = {w: draw.choice([3, 4, 7, 15, 40, 200]) for w in words}
    assert forms(spark, counts, crowded) == brute_force(counts)


@pytest.mark.parametrize("at", range(9))
def test_an_edit_at_every_place_is_found(spark, at):
    word = "abcdefgh"
    variants = {word, word[:at] + "x" + word[at:]} | ({word[:at] + word[at + 1 :], word[:at] + "x" + word[at + 1 :]} if at < 8 else set())
    df = spark.createDataFrame([(w,) for w in variants], "word string")
    for crowded in (0, 10**9):
        pairs = [tuple(r) for r in spelling.near_pairs(df, crowded).collect()]
        assert set(pairs) == {(a, b) for a in variants for b in variants if one_edit(a, b)} and len(set(pairs)) == len(pairs)


def test_words_of_texts(spark, docs):
    rows = [(i, "Äpfel straße ÉCLAIR×x tiny abcde-fghij " + "x" * 3000) for i in range(400)] + [(None, "abcde"), (1, None), (2, "")]
    df = docs(rows, n=1, word="'clash'", code=0)
    counted = {r["word"]: r["n"] for r in spelling.word_counts(spelling.with_typos(spelling.runs(df))).collect()}
    expected = Counter()
    for doc_id, text in rows:
        for run in ("Äpfel", "straße", "Éclair×x".replace("É", "É"), "abcde", "fghij", "x" * 3000) if text and len(text) > 5 else ("abcde",) if text else ():
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            expected[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    assert counted == {w: n for w, n in expected.items() if len(w) >= 5 and n >= 3}


def test_no_words(spark, docs):
    assert spelling.spelling_forms(spelling.word_counts(spelling.with_typos(spelling.runs(docs([]))))).collect() == []
