import hashlib
import random

import numpy as np
import pytest

from rollcall.llm import substrings


def plain(rows, length):
    least = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1) if doc is not None else ():
            least[data[i : i + length]] = min(least.get(data[i : i + length], doc), doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1) if doc is not None else ():
            if least[data[i : i + length]] < doc:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made_rows(seed):
    rng = random.Random(seed)
    words = ["alpha", "béta", "gamma", "delta", "ö"]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 80))) for _ in range(20)]
    rows = []
    for i in range(70):
        text = " ".join(rng.sample(base, rng.randint(1, 3)))
        rows.append((i, text[: rng.randint(0, len(text))] if rng.random() < 0.3 else text))
    extra = [(200, None), (201, ""), (None, rows[0][1]), (5, rows[5][1]), (6, base[0] + base[1]), (202, "a" * 400), (203, "a" * 300), (204, "\0" * 120), (205, "b" + "\0" * 90)]
    return rows + extra


@pytest.mark.parametrize("seed", [1, 2])
def test_removal_matches_brute_force(docs, seed):
    rows = made_rows(seed)
    found = substrings.remove_repeats(docs(rows, key=1, sha=2, part=3), bucket_bytes=4000, fragment_bytes=3000).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain(rows, 50)


def test_long_texts_are_hashed_in_stretches(docs, monkeypatch):
    monkeypatch.setattr(substrings, "STRETCH", 256)
    texts = [made_rows(3)[i][1].encode() for i in range(8)] + [b"x" * 700]
    split = substrings._blocks(texts, 50)
    monkeypatch.setattr(substrings, "STRETCH", 1 << 20)
    whole = substrings._blocks(texts, 50)
    assert sorted(zip(*(c.tolist() for c in split), strict=True)) == sorted(zip(*(c.tolist() for c in whole), strict=True))


def test_interval_classes_are_equal_prefixes():
    text = np.append(np.frombuffer(b"banana-bandana-banana-an", np.uint8).astype(np.uint16) + 1, 0)  # ends in a mark
    order, classes = substrings.equal_prefix_classes(text, 4)
    prefix = {int(p): bytes(text[p : p + 4].astype(np.uint8)) for p in order if p + 4 < text.size}
    for a, ca in zip(order.tolist(), classes, strict=True):
        for b, cb in zip(order.tolist(), classes, strict=True):
            if a in prefix and b in prefix:
                assert (ca == cb) == (prefix[a] == prefix[b])


def test_an_empty_table(docs):
    assert substrings.remove_repeats(docs([])).count() == 0
