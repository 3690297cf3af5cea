"""Best-position search against scoring every document."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
from tests.llm.fixtures import AWKWARD, invented, table, words

from quarry.llm.best_position import Shard, ranked_search


def brute(docs, items, k=10):
    """{item: [(doc_id, score), ...]} by scoring every document of ``(doc_id, text)`` rows."""
    cut = [(i, Counter(words(t))) for i, t in docs]
    cut = [(i, c) for i, c in cut if c]
    n = len(cut)
    total = sum(sum(c.values()) for _, c in cut)
    df = Counter(t for _, c in cut for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(words(t))
    out = {}
    for item, terms in asked.items():
        scored = []
        for i, c in cut:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in terms if c[t])
            if score > 0:
                scored.append((i, score))
        if scored:
            out[item] = sorted(scored, key=lambda x: (-x[1], math.inf if x[0] is None else x[0]))[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["item_id"] is None, r["item_id"], r["rank"])):
        own = out.setdefault(r["item_id"], [])
        assert r["rank"] == len(own) + 1
        own.append((r["doc_id"], r["score"]))
    return out


def asks(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_equals_scoring_every_document(spark):
    rng = random.Random(11)
    texts = [invented(rng, rng.randint(0, 80)) for _ in range(700)]
    texts += [texts[3]] * 60 + ["the " * 50] * 30 + ["the or the or an"] * 30  # ties beyond the tenth place
    docs = [(900 - k, t) for k, t in enumerate(texts)]
    items = [(k, " ".join(rng.choice(texts).split()[:25])) for k in range(25)] + [(100, "the"), (101, "or AN the"), (102, texts[3])]
    want = brute(docs, items)
    frame = table(spark, texts, ids=[i for i, _ in docs])
    assert found(ranked_search(frame, asks(spark, items))) == want
    # Shards and partitions do not change the result.
    assert found(ranked_search(frame.repartition(6), asks(spark, items), shard_docs=50)) == want
    assert found(ranked_search(frame, asks(spark, items), k=3)) == brute(docs, items, 3)


def test_awkward_texts_shared_ids_and_clashing_names(spark):
    ids = [5, None, *range(len(AWKWARD) - 2)]
    items = [(1, "one two word"), (1, "same x"), (None, "1 2 É"), (None, "a"), (2, None), (3, ""), (4, "!!"), (5, "zzz"), (6, "x" * 70_000)]
    docs = table(spark, AWKWARD, ids=ids, clash=True)
    for name in ("length", "terms", "tf", "spread", "shard", "role", "item_id", "term", "w", "df"):
        docs = docs.withColumn(name, docs["source"])
    asked = asks(spark, items)
    for name in ("doc_id", "bit", "rank", "score"):
        asked = asked.withColumn(name, asked["text"])
    assert found(ranked_search(docs, asked)) == brute(list(zip(ids, AWKWARD, strict=True)), items)


def test_empty_tables(spark):
    docs, items = table(spark, ["one two"]), asks(spark, [(1, "one")])
    assert ranked_search(docs.limit(0), items).collect() == []
    assert ranked_search(docs, items.limit(0)).collect() == []
    assert ranked_search(table(spark, [None, "", "..."]), items).collect() == []


def test_stops_early_but_not_at_ties():
    n = 5000
    rng = np.random.default_rng(12)
    tf = rng.integers(1, 4, (n, 2))
    tf[:40] = 50  # forty equal best documents
    order = rng.permutation(n)
    shard = Shard(order, np.full(n, 100), ["a b"] * n, [x.astype("<i4").tobytes() for x in tf], n, 100 * n)
    best, read = shard.search(["a", "b"], [3, 2], 10)
    assert [shard.doc_ids[d] for d, _ in best] == sorted(order[:40].tolist())[:10]
    assert 80 <= read < n  # past the ties of both lists, and far from their ends
