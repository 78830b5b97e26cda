"""Embedding near-duplicates against brute force: links, groups, blocks, odd vectors and recall."""

import numpy as np
import pytest

from rollcall.llm import spherical

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute_force(rows, cut=0.95):
    def unit(v):
        v = np.array([np.nan if x is None else x for x in (v if v is not None and len(v) else [0])], np.float32).astype(float)
        return v / np.linalg.norm(v) if np.isfinite(v).all() and np.linalg.norm(v) > 0 else None

    units = [unit(v) for _, v in rows]
    near = [[j for j, b in enumerate(units) if j != i and a is not None and b is not None and len(a) == len(b) and a @ b >= cut] for i, a in enumerate(units)]
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((vec_id, len(near[i]), least, vec_id == least))
    return sorted(out, key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)
    df = df.selectExpr("*", "'clash' AS filter", "1 AS root")
    return sorted((tuple(r) for r in spherical.near_duplicate_vectors(df, **options).collect()), key=str)


def near(draw, vector, cosine):
    unit = vector / np.linalg.norm(vector)
    other = draw.standard_normal(len(vector))
    other -= (other @ unit) * unit
    return cosine * unit + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


@pytest.mark.parametrize("block_rows", [2048, 16])
def test_groups_of_near_copies(spark, block_rows):
    draw = np.random.default_rng(3)
    rows = [draw.standard_normal(32) for _ in range(80)]
    rows += [near(draw, rows[5], c) for c in np.linspace(0.965, 1, 90)]  # a crowd whose members link in part
    rows += [rows[0]] * 30 + [rows[0] * 2.5]
    for _ in range(8):  # a chain
        rows.append(near(draw, rows[-1], 0.97))
    rows = list(enumerate(rows))
    assert found(spark, rows, block_rows=block_rows) == brute_force(rows)


def test_odd_vectors(spark):
    a = [1.0, 0.0, 0.5]
    rows = [(1, a), (1, a), (None, a), (2, None), (3, []), (4, [0.0] * 3), (5, [float("nan"), 1, 1]), (6, [None, 1.0, 1.0])]
    rows += [(7, [float("inf"), 1, 1]), (8, [1.0, -0.0, 0.5]), (9, [1.0, 0.0, 0.5, 0.0]), (10, [1.0]), (11, [2.0]), (12, [-1.0]), (None, [0.0, 9.0, 0.0])]
    assert found(spark, rows) == sorted([(i, n, c, i == c) for i, n, c, _ in brute_force(rows)], key=str)
    assert found(spark, []) == []


@pytest.mark.parametrize("vectors", [500, 50_000])
def test_recall_of_pairs_at_the_threshold(vectors):
    """At a cosine of 0.95, the hardest, the filters keep at least 97 of 100 pairs."""
    draw = np.random.default_rng(vectors)
    left = [draw.standard_normal(64) for _ in range(600)]
    right = np.array([near(draw, v, 0.95) for v in left])
    left = np.array([v / np.linalg.norm(v) for v in left])
    met = np.zeros(len(left), bool)
    for code in spherical.product_codes(64, vectors):
        sides = [set(zip(*(x.tolist() for x in code.decode(side)), strict=True)) for side in (left, right)]
        met[[i for i, _ in sides[0] & sides[1]]] = True
    assert met.mean() >= 0.97
