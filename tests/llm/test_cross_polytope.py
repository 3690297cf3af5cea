"""Cross-polytope neighbours against a comparison with all rows."""

from __future__ import annotations

import math

import numpy as np

from quarry.llm.cross_polytope import losses, nearest, nearest_axis, nearest_neighbours, rotated, units

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=100, k=10):
    """{query: [(score, id), ...]} of the k nearest valid rows, by plain loops."""
    valid = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in valid:
        if q % every == 0:
            own = {(float(np.sqrt(((np.array(a) - np.array(b)) ** 2).sum())), i) for i, b in valid if i != q and len(a) == len(b)}
            out[q] = sorted(own)[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        own = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(own) + 1
        own.append((r["score"], r["vec_id"]))
    return out


def make(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def recall(got, want):
    pairs = [(q, i) for q, own in want.items() for _, i in own]
    return sum(i in {x for _, x in got.get(q, [])} for q, i in pairs) / len(pairs)


def test_recall_and_exact_scores_on_random_directions(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(6000, 24))
    v[1000:3000] = v[7] + 0.05 * rng.normal(size=(2000, 24))  # a third lies close together
    v *= rng.uniform(0.5, 2, (6000, 1))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    want = brute(rows)
    got = found(nearest_neighbours(make(spark, rows)))
    assert recall(got, want) >= 0.9
    exact = {(q, i): s for q, own in brute(rows, k=6000).items() for s, i in own}
    assert all(exact[q, i] == s for q, own in got.items() for s, i in own)
    # Splitting groups loses nothing: the same buckets are probed.
    assert found(nearest_neighbours(make(spark, rows).repartition(5), group_rows=100)) == got


def test_copies_ties_invalid_rows_and_clashing_names(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 8)).tolist()
    rows = [(i, base[i % 40]) for i in range(400)]  # ten copies of each: ties go to smaller ids
    rows += [(1000 + i, base[0]) for i in range(600)]  # a hot vector
    rows += [(100, base[20]), (100, base[20])]  # a repeated row: once
    rows += [(None, base[3]), (2000, None), (2100, []), (2200, [0.0] * 8), (2300, [None, *base[1][1:]]),
             (2400, [float("nan"), *base[1][1:]]), (2500, [float("inf"), *base[1][1:]])]
    rows += [(2600, [1.0, 2.0]), (2700, [1.0, 2.5]), (2800, [3.0]), (-100, base[5])]
    docs = make(spark, rows)
    for name in ("id", "vec", "vector", "t", "digit", "role", "n", "size", "score", "rank"):
        docs = docs.withColumn(name, docs["label"])
    want = {q: own for q, own in brute(rows).items() if own}
    assert found(nearest_neighbours(docs, recall=1.0)) == want  # all queries are in the sample, so the radius finds all


def test_too_few_candidates_in_the_buckets_are_made_up(spark):
    rng = np.random.default_rng(3)
    far = rng.normal(size=(500, 64))
    near = np.tile(np.eye(64)[0], (3, 1)) + 1e-3 * rng.normal(size=(3, 64))
    rows = [(7 * i + 1, x.tolist()) for i, x in enumerate(far)] + [(7000 + 7 * i, x.tolist()) for i, x in enumerate(near)]
    want = brute(rows, every=7)
    got = found(nearest_neighbours(make(spark, rows), every=7, recall=0.05, group_rows=200))
    assert {q: len(own) for q, own in got.items()} == dict.fromkeys(want, 10)


def test_empty_and_tiny_tables(spark):
    assert nearest_neighbours(make(spark, [(1, [1.0])]).limit(0)).collect() == []
    assert nearest_neighbours(make(spark, [(0, [1.0])])).collect() == []
    assert found(nearest_neighbours(make(spark, [(0, [1.0, 0.0]), (5, [0.0, 1.0])]))) == {0: [(math.sqrt(2), 5)]}


def test_rotation_keeps_lengths_and_the_own_bucket_loses_nothing():
    v = units(np.random.default_rng(4).normal(size=(50, 48)))
    turned = rotated(v, 9)
    assert turned.shape == (50, 64) and np.allclose((turned ** 2).sum(axis=1), 1)
    assert np.allclose(turned @ turned.T, v @ v.T)
    assert np.allclose(losses(turned)[np.arange(50), nearest_axis(turned)], 0)


def test_nearest_is_exact_where_products_cancel():
    rows = 1e8 + np.arange(30, dtype=float)[:, None] * 1e-3
    i, j, d = nearest(np.array([-1]), np.array([[1e8]]), np.arange(30), rows, 10)
    assert j.tolist() == list(range(10)) and (d == np.abs(rows[:10, 0] - 1e8)).all()
