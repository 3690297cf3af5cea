"""Stored sketches of a grown table, and lists in bounded chunks."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.operators import collect
from quarry.operators import sketches as S


def test_only_new_files_are_read_and_ranks_hold(spark, scratch):
    table, store = f"{scratch}/t", f"{scratch}/s"
    assert S.stored_sketches(spark, store) is None
    seen = []
    for k in range(3):
        part = spark.range(k * 20_000, (k + 1) * 20_000, numPartitions=2).select(
            (F.col("id") % 2).cast("string").alias("g"), F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("double").alias("v"))
        part.write.mode("append").parquet(table)
        new = S.update_sketches(spark, table, store, "v", ["g"])
        assert len(new) == 2 and not set(new) & set(seen)
        seen += new
        assert S.update_sketches(spark, table, store, "v", ["g"]) == []
    held = S.stored_sketches(spark, store)
    assert held.count() == 12
    got = {r["g"]: r for r in S.sketched_quantiles(held, [0.1, 0.5, 0.99], ["g"], ["a", "b", "c"]).collect()}
    values = defaultdict(list)
    for r in spark.read.parquet(table).collect():
        values[r["g"]].append(r["v"])
    for g, own in values.items():
        own.sort()
        assert got[g]["n"] == len(own)
        for name, p in (("a", 0.1), ("b", 0.5), ("c", 0.99)):
            rank = sum(v <= got[g][name] for v in own) / len(own)
            assert abs(rank - p) <= 0.01


def test_a_retried_update_counts_nothing_twice(spark, scratch, monkeypatch):
    table, store = f"{scratch}/t", f"{scratch}/s"
    spark.range(100).select(F.col("id").cast("double").alias("v")).write.parquet(table)
    S.update_sketches(spark, table, store, "v")
    monkeypatch.setattr(S, "stored_sketches", lambda *a: None)  # as if the first update had not been seen
    S.update_sketches(spark, table, store, "v")
    monkeypatch.undo()
    assert S.sketched_quantiles(S.stored_sketches(spark, store), [0.5]).first()["n"] == 100


def test_sketches_of_nulls_nan_and_nothing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("b", None), (None, 4.0)], "g string, v double")
    got = {r["g"]: tuple(r)[1:] for r in S.sketched_quantiles(S.sketch(df, "v", ["g"]), [0.5], ["g"]).collect()}
    assert got == {"a": (1, 1.0), "b": (0, None), None: (1, 4.0)}
    assert S.sketched_quantiles(S.sketch(df.limit(0), "v", ["g"]), [0.5], ["g"]).collect() == []


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_chunks_join_to_the_whole_list(spark, size):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice([None, 5, 5, 5, rng.randint(0, 200)])) for _ in range(900)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(4)
    want = defaultdict(list)
    for k, v in rows:
        if v is not None:
            want[k].append(v)
    got = defaultdict(dict)
    for r in collect.collect_chunks(df, "k", "v", size).collect():
        got[r["k"]][r["chunk"]] = r["items"]
    assert {k: [x for c in sorted(own) for x in own[c]] for k, own in got.items()} == {k: sorted(v) for k, v in want.items()}
    for own in got.values():
        assert sorted(own) == list(range(len(own)))
        assert all(len(own[c]) == size for c in sorted(own)[:-1])
    assert collect.collect_chunks(df.limit(0), "k", "v", size).collect() == []
