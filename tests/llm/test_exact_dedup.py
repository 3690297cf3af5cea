import hashlib
import random

from quarry.llm.exact_dedup import exact_dedup, keep_exact
from tests.llm.fixtures import AWKWARD, invented, lower_ascii, table


def brute(rows):
    best, count = {}, {}
    for i, t in rows:
        k = lower_ascii(t)
        count[k] = count.get(k, 0) + 1
        if i is not None and (best.get(k) is None or i > best[k]):
            best[k] = i
        best.setdefault(k, None)
    return sorted(((i, best[lower_ascii(t)], count[lower_ascii(t)], i == best[lower_ascii(t)],
                    hashlib.sha256(lower_ascii(t).encode()).hexdigest()) for i, t in rows), key=str)


def check(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    docs = table(spark, texts, ids, clash=True).repartition(5)
    got = sorted((tuple(r) for r in exact_dedup(docs).collect()), key=str)
    assert got == brute(list(zip(ids, texts, strict=True)))
    kept = keep_exact(docs)
    assert kept.columns == docs.columns
    rows = sorted(((r["doc_id"], hashlib.sha256(lower_ascii(r["text"]).encode()).hexdigest()) for r in kept.collect()), key=str)
    assert rows == sorted({(r[0], r[4]) for r in got if r[3]}, key=str)


def test_awkward_texts(spark):
    check(spark, AWKWARD)


def test_hot_group_and_many_small(spark):
    rng = random.Random(1)
    texts = ["Hot copy É"] * 400 + ["hot COPY É"] * 200 + ["hot copy é"] * 3 + [invented(rng, 6) for _ in range(300)]
    rng.shuffle(texts)
    check(spark, texts + texts[:50])


def test_repeated_and_null_ids(spark):
    check(spark, ["a", "A", "b", "b", "c", None, ""], [1, 1, 2, 2, None, None, 5])


def test_empty_table(spark):
    docs = table(spark, ["x"]).limit(0)
    assert exact_dedup(docs).count() == 0
    assert keep_exact(docs).count() == 0
