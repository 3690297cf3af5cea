import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

import quarry.llm.components as contraction
from quarry.llm.components import components, least_labels
from quarry.llm.jaccard_join import _compared, jaccard_join, keep_one, needed_runs
from tests.llm.fixtures import AWKWARD, invented, table, words


def brute(texts, threshold=0.8, size=5):
    sets = {}
    for i, t in enumerate(texts):
        w = words(t)
        sets[i] = frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()
    first, rep = {}, {}
    for i, s in sets.items():
        rep[i] = first.setdefault(s, i) if s else i
    post, links = defaultdict(list), defaultdict(set)
    for i in first.values():
        shared = Counter(j for x in sets[i] for j in post[x])
        for j, n in shared.items():
            if n >= threshold * (len(sets[i]) + len(sets[j]) - n) - 1e-9:
                links[i].add(j)
                links[j].add(i)
        for x in sets[i]:
            post[x].append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in links:
        for j in links[i]:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    copies = Counter(rep.values())
    return {i: (find(rep[i]), len(links[rep[i]]), rep[i], copies[rep[i]]) for i in sets}


def corpus(seed=11):
    rng = random.Random(seed)
    texts = list(AWKWARD)
    passage = invented(rng, 60)
    base = invented(rng, 150).split()
    for _ in range(420):  # a large group of near copies of one text
        t = list(base)
        for _ in range(rng.randint(0, 2)):
            t[rng.randrange(len(t))] = invented(rng, 1)
        texts.append(" ".join(t))
    for _ in range(500):  # a passage that many documents share
        texts.append(passage + " " + invented(rng, rng.randint(20, 200)))
    for _ in range(60):  # small groups around the threshold
        t = invented(rng, rng.randint(3, 120)).split()
        for _ in range(rng.randint(1, 6)):
            u = list(t)
            for _ in range(rng.randint(0, 3)):
                u[rng.randrange(len(u))] = invented(rng, 1)
            texts.append(" ".join(u))
    texts += ["Exact copies of one text, many of them here"] * 300
    return texts


def test_against_brute_force(spark):
    texts = corpus()
    docs = table(spark, texts, clash=True).repartition(6)
    got = {r["doc_id"]: tuple(r)[1:] for r in jaccard_join(docs).collect()}
    want = brute(texts)
    assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, w in want.items() if w[0] == i}


def test_null_and_repeated_ids(spark):
    docs = table(spark, ["a b c d e f g", "a b c d e f g", "a b c d e f g", None], [3, 3, None, 9])
    assert sorted((str(r["doc_id"]), str(r["class_id"]), r["n_copies"]) for r in jaccard_join(docs).collect()) == [
        ("3", "3", 2), ("3", "3", 2), ("9", "9", 1), ("None", "None", 1)]
    assert keep_one(docs).count() == 4


def test_one_id_over_different_texts(spark):
    rng = random.Random(4)
    a, b, c = (invented(rng, 40) for _ in range(3))
    near_a, near_b = a + " one more", b + " and one"
    docs = table(spark, [a, b, near_a, near_b, c, c], [5, 5, 7, 2, 5, 5])
    got = sorted((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in jaccard_join(docs).collect())
    assert got == [(2, 2, 1, 1), (5, 2, 1, 1), (5, 5, 0, 2), (5, 5, 0, 2), (5, 5, 1, 1), (7, 5, 1, 1)]
    assert sorted((r["doc_id"], r["text"]) for r in keep_one(docs).collect()) == sorted([(5, a), (2, near_b), (5, c), (5, c)])


def test_blocks_of_a_component_count_every_pair_once():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 60, 300).astype(np.uint64)
    sets = [np.unique(np.r_[base[rng.random(300) > rng.uniform(0, 0.2)], rng.integers(0, 1 << 60, rng.integers(0, 60)).astype(np.uint64)])
            for _ in range(700)]
    near = np.array([[len(np.intersect1d(x, y, True)) >= 0.8 * len(np.union1d(x, y)) - 1e-6 for y in sets] for x in sets[:150]])
    every = np.arange(700)
    links, label = _compared(sets, every, every, 0.8)
    assert (links[:150] == near.sum(axis=1) - 1).all()
    half, rest = every[:333], every[333:]
    parts = [_compared(sets, x, y, 0.8) for x, y in ((half, half), (half, rest), (rest, rest))]
    assert (sum(p[0] for p in parts) == links).all()
    assert (least_labels(700, np.tile(every, 3), np.concatenate([p[1] for p in parts])) == label).all()


def test_contraction_keeps_components_at_any_bound(monkeypatch):
    rng = random.Random(6)
    for held in (1, 7, 50):
        monkeypatch.setattr(contraction, "HELD", held)
        for _ in range(60):
            n = rng.randint(2, 80)
            edges = sorted((max(x), min(x)) for x in ((rng.randrange(n), rng.randrange(n)) for _ in range(120)) if x[0] != x[1])
            a, b = np.array(edges, np.int64).T if edges else np.zeros((2, 0), np.int64)
            batches = [pa.RecordBatch.from_arrays([pa.array(a[k:k + 9]), pa.array(b[k:k + 9])], names=["a", "b"]) for k in range(0, len(a), 9)]
            out = [(x, y) for r in contraction._contracted(iter(batches)) for x, y in zip(r["a"].to_pylist(), r["b"].to_pylist(), strict=True)]
            got = least_labels(n, np.array([x for x, _ in out], np.int64), np.array([y for _, y in out], np.int64))
            assert (got == least_labels(n, a, b)).all() and all(x > y for x, y in out)


def test_empty_table(spark):
    docs = table(spark, ["x"]).limit(0)
    assert jaccard_join(docs).count() == 0
    assert keep_one(docs).count() == 0


def test_runs_reach_the_recall():
    assert needed_runs(0.8, 2, 0.99999, 6) >= 4
    assert needed_runs(1.0, 2, 0.9, 6) == 1


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (None, 1), (7, 6), (6, 8)] + [(k, k + 1) for k in range(100, 160)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 6} | {k: 100 for k in range(100, 161)}
