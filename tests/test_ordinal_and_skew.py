"""Global ordinals, dictionaries, prediction metrics and salted joins against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import ingest
from quarry.operators import models as M
from quarry.operators.ordinal import running_before


@pytest.mark.parametrize("parts", [1, 8])
def test_running_before(spark, parts):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), k, rng.choice([None, 0, 1, 5])) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, k long, w int").repartition(parts)
    got = {(r["g"], r["k"]): r["before"] for r in running_before(df, [F.desc("k")], F.col("w"), ["g"]).collect()}
    want, sums = {}, Counter()
    for g, k, w in sorted(rows, key=lambda r: -r[1]):
        want[g, k] = sums[g]
        sums[g] += w or 0
    assert got == want
    assert running_before(df.limit(0), [F.desc("k")]).collect() == []
    ranks = {r["k"]: r["before"] for r in running_before(df, [F.asc("k")]).collect()}
    assert ranks == {k: k for k in range(500)}


def test_dictionary_of_many_categories(spark):
    """Two hundred thousand categories: ranks are dense and ordered, and no list of them is collected."""
    df = spark.range(300_000).select(F.when(F.col("id") < 200_000, F.col("id")).otherwise(F.col("id") % 1000).cast("string").alias("c"))
    d = M.category_dictionary(df, "c")
    assert d.agg(F.count("*"), F.min("index"), F.max("index"), F.countDistinct("index")).first()[:] == (200_000, 0, 199_999, 200_000)
    top = [r["value"] for r in d.where("index < 3").orderBy("index").collect()]
    assert top == ["0", "1", "10"]
    assert d.where("index < 1000").agg(F.min("count")).first()[0] == 101


def test_features_take_nulls_unseen_and_constant_columns(spark):
    train = spark.createDataFrame([(1.0, "x", 2.0), (3.0, "y", 2.0), (None, "x", 2.0), (float("nan"), None, 2.0)], "a double, c string, k double")
    fitted = M.fit_features(train, ["a", "k"], ["c"])
    test = spark.createDataFrame([(None, "x", 2.0), (2.0, "new", 4.0), (5.0, None, None)], "a double, c string, k double")
    sd = fitted.numeric["a"][1]
    assert fitted.numeric["a"][0] == 2.0 and fitted.numeric["k"] == (2.0, 1.0) and fitted.sizes == {"c": 2}
    got = sorted((r["a__num"], r["k__num"], r["c__idx"]) for r in fitted.columns(test).collect())
    assert got == sorted([(2.0 / sd, 2.0, 0.0), (2.0 / sd, 4.0, 2.0), (5.0 / sd, 2.0, 2.0)])
    vectors = [r["features"].toArray().tolist() for r in fitted.transform(test).collect()]
    assert sorted(v[2:] for v in vectors)[-1] == [1.0, 0.0, 0.0] and all(len(v) == 5 for v in vectors)


def _auc(rows):
    pos, neg = [s for y, s in rows if y == 1], [s for y, s in rows if y == 0]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg)) if pos and neg else None


def test_prediction_metrics_and_a_wrong_score(spark):
    rng = random.Random(2)
    rows = [("m1", y, rng.choice([0.1, 0.2, 0.5, 0.9]) + 0.3 * y) for y in (rng.choice([0.0, 1.0]) for _ in range(400))]
    rows += [("m2", float(k % 2), 0.5) for k in range(50)] + [("m3", 1.0, 0.7)] * 5

    def figures(rows):
        df = spark.createDataFrame([(m, y, s, float(s >= 0.6)) for m, y, s in rows], "model string, label double, score double, prediction double")
        return {r["model"]: r for r in M.prediction_metrics(df.repartition(5)).collect()}

    got = figures(rows)
    for m in ("m1", "m2", "m3"):
        own = [(y, s) for name, y, s in rows if name == m]
        c = Counter((y, float(s >= 0.6)) for y, s in own)
        r = got[m]
        assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (c[1.0, 1.0], c[0.0, 1.0], c[1.0, 0.0], c[0.0, 0.0])
        want = _auc(own)
        assert r["auc"] == (want if want is None else pytest.approx(want, abs=1e-12))
    assert [got[m]["rank"] for m in ("m1", "m2", "m3")] == [1, 2, 3]
    k = next(i for i, r in enumerate(rows) if r[1] == 1.0)
    wrong = figures([(m, y, -1.0 if i == k else s) for i, (m, y, s) in enumerate(rows)])
    assert wrong["m1"]["auc"] != got["m1"]["auc"]


def test_compare_models_writes_its_predictions(spark, scratch):
    rows = [(k, float(k % 3 == 0), k % 3 + 0.1 * (k % 7), f"s{k % 4}") for k in range(300)]
    df = spark.createDataFrame(rows, "id long, label double, x double, s string")
    rules = {"x": M.MedianRule("x"), "s": M.CategoryRate("s")}
    got = M.compare_models(df.where("id % 5 > 0"), df.where("id % 5 = 0"), None, rules, order_key="id", predictions=f"{scratch}/p").collect()
    table = spark.read.parquet(f"{scratch}/p")
    assert table.groupBy("model", "key").count().where("count <> 1").count() == 0
    for r in got:
        own = [(x["label"], x["score"]) for x in table.where(F.col("model") == r["model"]).collect()]
        assert len(own) == r["n"] == 60 and r["auc"] == pytest.approx(_auc(own), abs=1e-12)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_salted_join_equals_the_plain_one(spark, how):
    rng = random.Random(3)
    keys = [(7, "x")] * 5 + [(None, "x"), (3, None)] + [(k, "x") for k in range(20)]
    fact = spark.createDataFrame([(*rng.choice(keys), k % 50) for k in range(3000)], "a int, b string, v long")
    dim = spark.createDataFrame([(k, "x", f"d{k}{j}") for k in range(5, 30) for j in range(2)] + [(None, "x", "n"), (3, None, "m")],
                                "a int, b string, name string")
    rows = lambda df: Counter(tuple(r) for r in df.select("a", "b", "v", "name").collect())
    plain = rows(ingest.enrich(fact, dim, ["a", "b"], how))
    for pieces in (4, 40):
        assert rows(ingest.enrich_salted(fact, dim, ["a", "b"], how, pieces)) == plain
    assert rows(ingest.enrich_salted(fact.limit(0), dim, ["a", "b"], how)) == rows(ingest.enrich(fact.limit(0), dim, ["a", "b"], how))
    assert rows(ingest.enrich_salted(fact, dim.limit(0), ["a", "b"], how)) == rows(ingest.enrich(fact, dim.limit(0), ["a", "b"], how))


def test_a_hot_key_is_dealt_over_tasks(spark):
    """Half of the rows have one key and a fifth none: no task gets more than twice the median."""
    fact = spark.range(200_000).select(
        "id", F.when(F.col("id") % 10 < 5, 1).when(F.col("id") % 10 < 7, F.lit(None)).otherwise(F.col("id") % 997).cast("long").alias("k"))
    dim = spark.range(997).select(F.col("id").alias("k"), F.lit("d").alias("name"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        sizes = lambda df: sorted(r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
        salted = sizes(ingest.enrich_salted(fact, dim, "k", "left", 256))
        plain = sizes(ingest.enrich(fact, dim, "k", "left"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert max(plain) > 90_000 and max(salted) <= 2 * salted[len(salted) // 2]
