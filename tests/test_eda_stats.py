"""EDA tables and statistical tests."""

from __future__ import annotations

import math

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from quarry.functions.distributions import chi2_upper_p, t_two_sided_p
from quarry.operators import collect as C
from quarry.operators import eda as E
from quarry.operators import stats as T


def test_histogram_sums_to_values_inside(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    h = E.histogram(li, "l_quantity", 10.0, 20.0, 7).collect()
    assert [r["bin"] for r in h] == list(range(7))
    assert sum(r["count"] for r in h) == li.where("l_quantity BETWEEN 10 AND 20").count()
    # the top edge belongs to the last bin
    df = spark.createDataFrame([(0.0,), (1.0,), (0.5,), (2.0,), (None,)], "v double")
    assert [r["count"] for r in E.histogram(df, "v", 0.0, 1.0, 2).collect()] == [1, 2]


def test_crosstab_zero_cells_and_shares(spark):
    df = spark.createDataFrame([("x", "p"), ("x", "p"), ("x", "q"), ("y", "p"), (None, "q")],
                               "a string, b string")
    cells = {(r["a"], r["b"]): r for r in E.crosstab_long(df, "a", "b", complete=True).collect()}
    assert cells[("y", "q")]["count"] == 0
    assert cells[("x", "p")]["row_share"] == pytest.approx(2 / 3)
    assert sum(r["count"] for r in cells.values()) == 5


def test_profiles(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (None, "b"), (float("nan"), "c")],
                               "v double, s string")
    p = E.profile_numeric(df, ["v"]).first()
    assert (p["n"], p["n_null"], p["min"], p["max"], p["median"]) == (2, 2, 1.0, 2.0, 1.5)
    m = {r["column"]: r for r in E.profile_missing(df).collect()}
    assert m["s"]["n_null"] == 1 and m["v"]["null_share"] == 0.5      # NaN counts as null
    vc = E.value_counts(spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "x string"), "x", 2)
    assert [(r["x"], r["count"]) for r in vc.collect()] == [("b", 2), ("a", 1)]


def test_box_and_correlation(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, -float(i)) for i in range(1, 11)] + [(100.0, 0.0, 0.0)],
                               "v double, w double, z double")
    b = E.box_stats(df, "v").first()
    assert b["n_outliers"] == 1 and b["upper_whisker"] == 10.0
    corr = {(r["col_a"], r["col_b"]): r["corr"] for r in E.correlation_pairs(df, ["v", "w", "z"]).collect()}
    assert len(corr) == 3


def test_collect_ops(spark):
    df = spark.createDataFrame([("k", [1, -2, 3]), ("k", []), ("j", None)], "key string, items array<int>")
    sq = C.array_comprehension("items", keep=lambda x: x > 0, f=lambda x: x * x)
    got = {r["key"]: r["s"] for r in df.select("key", sq.alias("s")).collect() if r["s"]}
    assert got["k"] == [1, 9]
    rows = C.generate_rows(df, F.col("items"), ["key"], position="pos").collect()
    assert len(rows) == 3
    g = C.group_stats(spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, v double"),
                      ["k"], "v")
    assert {r["k"]: (r["n"], r["mean"]) for r in g.collect()} == {"a": (2, 2.0), "b": (0, None)}


def test_p_values_closed_forms():
    for t in (0.3, 1.0, 4.0):
        assert t_two_sided_p(t, 1) == pytest.approx(1 - 2 * math.atan(t) / math.pi, rel=1e-12)
        assert t_two_sided_p(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-10)
    for x in (0.1, 2.0, 30.0, 400.0):
        assert chi2_upper_p(x, 2) == pytest.approx(math.exp(-x / 2), rel=1e-12)
    assert chi2_upper_p(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-12)
    assert t_two_sided_p(None, 3) is None and chi2_upper_p(1.0, 0) is None


def test_t_test_edge_cases(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 1.0), ("c", 9.0), ("d", 5.0),
                                ("a", None)], "g string, v double")
    same = T.t_test(df, "v", "g", "a", "b").first()
    assert same["t"] is None and same["p"] is None          # zero variance in both
    one = T.t_test(df, "v", "g", "a", "d").first()
    assert one["df"] is None and one["n_a"] == 2             # one-row group


def test_welch_known_value(spark):
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    r = T.t_test(o, "o_totalprice", "o_orderpriority", "1-URGENT", "5-LOW").first()
    assert r["t"] == pytest.approx(2.1010354807588, rel=1e-9)
    assert r["p"] == pytest.approx(0.0356797, abs=1e-6)


def test_chi_square_matches_spark_ml(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    ours = T.chi_square(li, "l_returnflag", "l_linestatus").first()
    idx = li.select(
        F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0)
        .otherwise(2.0).alias("a"),
        F.when(F.col("l_linestatus") == "O", 0.0).otherwise(1.0).alias("label"))
    vec = idx.rdd.map(lambda r: (Vectors.dense([r["a"]]), r["label"])).toDF(["features", "label"])
    ref = ChiSquareTest.test(vec, "features", "label").first()
    assert ours["statistic"] == pytest.approx(float(ref.statistics[0]), rel=1e-9)
    assert ours["p"] == pytest.approx(float(ref.pValues[0]), rel=1e-6)
    assert ours["dof"] == ref.degreesOfFreedom[0]


def test_chi_square_zero_cell(spark):
    rows = [("x", "p")] * 10 + [("x", "q")] * 5 + [("y", "p")] * 7        # (y, q) never observed
    df = spark.createDataFrame(rows, "a string, b string")
    r = T.chi_square_summary(df, "a", "b").first()
    n, rx, ry, cp, cq = 22, 15, 7, 17, 5
    obs = {("x", "p"): 10, ("x", "q"): 5, ("y", "p"): 7, ("y", "q"): 0}
    expect = sum((obs[(a, b)] - ra * cb / n) ** 2 / (ra * cb / n)
                 for a, ra in (("x", rx), ("y", ry)) for b, cb in (("p", cp), ("q", cq)))
    assert r["statistic"] == pytest.approx(expect, rel=1e-12) and r["dof"] == 1
    yates = T.chi_square_summary(df, "a", "b", correction=True).first()
    expect_y = sum(max(abs(obs[(a, b)] - ra * cb / n) - 0.5, 0) ** 2 / (ra * cb / n)
                   for a, ra in (("x", rx), ("y", ry)) for b, cb in (("p", cp), ("q", cq)))
    assert yates["statistic"] == pytest.approx(expect_y, rel=1e-12)
    single = T.chi_square_summary(spark.createDataFrame([("x", "p"), ("x", "q")], "a string, b string"),
                                  "a", "b").first()
    assert single["dof"] == 0


def test_profile_empty_table_and_extras_ungrouped(spark):
    from quarry.operators import quantiles as Q
    empty = spark.createDataFrame([], "a double, b double")
    rows = {r["column"]: r for r in E.profile_numeric(empty, ["a", "b"]).collect()}
    assert set(rows) == {"a", "b"}
    assert all(r["n"] == 0 and r["n_null"] == 0 and r["mean"] is None and r["q1"] is None
               for r in rows.values())
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)] + [(None,)], "v double")
    q, _ = Q.quantile_table(df, "v", [0.5], names=["median"],
                            extra={"total": F.sum("v"), "nulls": F.count_if(F.col("v").isNull())})
    r = q.first()
    assert (r["n"], r["median"], r["total"], r["nulls"]) == (10, 5.5, 55.0, 1)


def test_correlations_of_many_columns(spark):
    """Thirty columns with gaps, through matrices, equal Spark's aggregate pair by pair."""
    from itertools import combinations

    n = 30
    cols = [F.when(F.pmod(F.xxhash64("id", F.lit(100 + k)), F.lit(5)) > 0,
                   1e6 * k + F.pmod(F.xxhash64("id", F.lit(k % 7)), F.lit(1000)) + 0.5 * k * F.pmod(F.xxhash64("id", F.lit(k)), F.lit(50))).alias(f"c {k}")
            for k in range(n - 2)]
    df = spark.range(2000).select(*cols, F.lit(3.0).alias("same"), F.lit(None).cast("double").alias("none")).repartition(6)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in E.correlation_pairs(df, df.columns).collect()}
    assert set(got) == set(combinations(df.columns, 2))
    some = [(a, b) for i, (a, b) in enumerate(combinations(df.columns[:n - 2], 2)) if i % 11 == 0]
    want = df.agg(*[F.corr(f"`{a}`", f"`{b}`") for a, b in some]).first()
    assert [got[pair] for pair in some] == [pytest.approx(w, abs=1e-9) for w in want]
    assert all(got[pair] is None for pair in got if "same" in pair or "none" in pair)
    assert E.gram_correlations(df.limit(0), ["same", "none"]).first()["corr"] is None
