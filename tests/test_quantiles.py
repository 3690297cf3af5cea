"""Distributed exact quantiles equal Spark's one-buffer ``percentile``."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import quantiles as Q

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.fixture(autouse=True)
def banding(monkeypatch):
    """These tables are small: band their values all the same, unless a test says otherwise."""
    monkeypatch.setattr(Q, "VALUE_LIMIT", 0)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "g string, v double")


def _ref(df, by):
    r = df.groupBy(*by).agg(F.count(Q.clean_value("v")).alias("n"),
                            F.percentile(Q.clean_value("v"), PROBS).alias("q"))
    return {tuple(x[k] for k in by): (x["n"], x["q"]) for x in r.collect()}


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)


def _check(df, by, **kw):
    names = [f"p{i}" for i in range(len(PROBS))]
    got = Q.quantiles(df, "v", PROBS, by=by, names=names, **kw).collect()
    ref = _ref(df, by)
    assert len(got) == len(ref)
    for row in got:
        n, q = ref[tuple(row[k] for k in by)]
        assert row["n"] == n
        for i, nm in enumerate(names):
            expect = q[i] if q is not None else None
            assert _close(row[nm], expect), (row, nm, expect)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_random_tied_constant_tiny(spark, by):
    rnd = random.Random(3)
    rows = [("a", rnd.gauss(0, 1)) for _ in range(3000)]
    rows += [("b", float(rnd.randint(0, 5))) for _ in range(2000)]      # heavy ties
    rows += [("c", 7.0)] * 50                                           # constant
    rows += [("d", 1.5)]                                                # one row
    rows += [("e", None)] * 3                                           # all null
    rows += [(None, 2.0), (None, 4.0)]                                  # null key
    rows += [("a", float("nan")), ("b", None)]                          # NaN and null
    _check(_frame(spark, rows), by)


def test_refinement_path(spark):
    rnd = random.Random(5)
    rows = [("a" if i % 3 else "b", rnd.random() * 1000) for i in range(5000)]
    rows += [("a", 500.0)] * 300
    # a tiny band limit forces the equal-width refinement rounds
    _check(_frame(spark, rows), ["g"], band_limit=50, cells=16)
    _check(_frame(spark, rows), [], band_limit=50, cells=16)


def test_missed_sketch_is_repaired(spark, monkeypatch):
    rnd = random.Random(7)
    rows = [("a", rnd.random()) for _ in range(2000)] + [("b", rnd.random()) for _ in range(500)]
    df = _frame(spark, rows)
    real = Q._band_exprs

    def wrong(probs, d):
        # bands far above every value: every wanted rank falls outside them
        approx, lo, hi = real(probs, d)
        return approx, [F.lit(5.0) for _ in lo], [F.lit(6.0) for _ in hi]

    monkeypatch.setattr(Q, "_band_exprs", wrong)
    monkeypatch.setattr(Q, "_SMALL_RANKS", 0.0)     # small groups would skip the sketch band
    _check(df, ["g"])


def test_small_groups_take_whole_range(spark, monkeypatch):
    # groups of a few hundred values: the band is [min, max], never a miss
    rnd = random.Random(9)
    rows = [("a", float(rnd.randint(0, 40))) for _ in range(400)] + [("b", rnd.random()) for _ in range(150)]
    calls = []
    real = Q._refine
    monkeypatch.setattr(Q, "_refine", lambda *a, **k: calls.append(1) or real(*a, **k))
    _check(_frame(spark, rows), ["g"])
    _check(_frame(spark, rows), [])
    assert not calls


def test_empty_table(spark):
    df = _frame(spark, [])
    out = Q.quartiles(df, "v").collect()
    assert len(out) == 1 and out[0]["n"] == 0 and out[0]["q1"] is None
    assert Q.quartiles(df, "v", by=["g"]).count() == 0


def test_approx_within_rank_error(spark):
    rnd = random.Random(11)
    vals = sorted(rnd.random() for _ in range(20000))
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = Q.quartiles(df, "v", method="approx", accuracy=1000).first()
    for p, nm in zip(Q.QUARTILE_PROBS, Q.QUARTILE_NAMES):
        rank = sum(1 for x in vals if x <= r[nm])
        assert abs(rank - p * len(vals)) <= len(vals) / 1000 + 1


def test_exact_matches_generated_table(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    got = Q.quartiles(li, "l_extendedprice").first()
    ref = li.agg(F.percentile("l_extendedprice", list(Q.QUARTILE_PROBS)).alias("q")).first()["q"]
    assert [got["q1"], got["median"], got["q3"]] == pytest.approx(ref, rel=1e-12)


def test_missed_sketch_is_repaired_ungrouped(spark, monkeypatch):
    rnd = random.Random(8)
    df = _frame(spark, [("a", rnd.random()) for _ in range(3000)])
    real = Q._band_index

    def wrong(probs, d):
        approx, lo, hi = real(probs, d)
        return approx, ["max" for _ in lo], ["max" for _ in hi]   # bands collapse onto the max

    monkeypatch.setattr(Q, "_band_index", wrong)
    monkeypatch.setattr(Q, "_SMALL_RANKS", 0.0)
    _check(df, [])


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]),
                          st.one_of(st.none(), st.integers(-5, 5).map(float),
                                    st.floats(-1e6, 1e6, allow_nan=False))),
                min_size=0, max_size=60),
       st.sampled_from([1, 2, 1000]))
def test_property_exact_equals_percentile(spark, rows, accuracy):
    # accuracy 1 and 2 make the sketch useless, so the repair path is exercised
    _check(_frame(spark, rows), ["g"], accuracy=accuracy, band_limit=8, cells=4)


def test_refinement_with_ranks_in_far_cells(spark):
    # floor(h) and ceil(h) of one quantile fall in the first and last cells:
    # each rank needs its own band, or the band never shrinks
    rows = [("x", v) for v in (-2.0, -2.0, -2.186681375826971e-139, -4.810561124153891e-231, 0.0,
                                1.0, 3.0, 4.0, 5.0, 5231.340862898389)]
    rows += [("y", v) for v in (-381228.78017530614, -5.0, 1.0, 2.0, 3.0, 4.0, 4.0,
                                127874.70593891758, 644196.0035465995)]
    _check(_frame(spark, rows), ["g"], accuracy=1000, band_limit=8, cells=4)
    _check(_frame(spark, rows), [], accuracy=1, band_limit=3, cells=2)


def test_hot_group_refined_next_to_small_groups(spark, monkeypatch):
    # one group holds most rows and is refined (its band, about 0.08 n rows at
    # accuracy 100, exceeds the limit); the small groups (n * 3/100 < 2) take
    # their whole range as the band in the same run
    rnd = random.Random(13)
    rows = [("hot", rnd.gauss(100.0, 15.0)) for _ in range(30000)]
    rows += [("hot", 100.0)] * 3000                      # a heavy tie inside the hot group
    rows += [(g, rnd.random() * 50) for g in ("a", "b", "c") for _ in range(50)]
    calls = []
    real = Q._refine
    monkeypatch.setattr(Q, "_refine", lambda *a, **k: calls.append(1) or real(*a, **k))
    _check(_frame(spark, rows), ["g"], accuracy=100, band_limit=500, cells=64)
    assert calls


def test_wide_values_match_percentile(spark):
    from quarry.operators.quantiles import exact_values_wide

    df = spark.range(40_000).select(
        F.rand(3).alias("u"), (F.col("id") % 7).cast("double").alias("few"), F.when(F.col("id") < 5, F.col("id")).alias("small"),
        F.lit(None).cast("double").alias("none"), F.exp(F.randn(5) * 20).alias("wild"), F.lit(2.5).alias("one"),
        F.when(F.col("id") % 3 == 0, float("nan")).otherwise(F.col("id")).alias("nans"))
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    for limit in (2_000_000, 10):
        for c, (n, got, x) in zip(df.columns, exact_values_wide(df, [F.col(c) for c in df.columns], probs, [{"s": F.count("*")}] * 7, band_limit=limit)):
            v = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
            want = df.agg(F.count(v).alias("n"), F.percentile(v, probs).alias("p")).first()
            assert n == want["n"] and x["s"] == 40_000
            assert got == pytest.approx(want["p"], rel=1e-12) if want["p"] else got == [None] * 5


def test_six_hundred_decades_and_many_probabilities(spark):
    df = spark.range(3_000).select(F.pow(F.lit(10.0), F.col("id") / 5 - 300).alias("v"))
    probs = [k / 100 for k in range(1, 100)]
    want = df.agg(F.percentile("v", probs)).first()[0]
    assert Q.exact_values(df, "v", probs, band_limit=200, cells=64)[1] == pytest.approx(want, rel=1e-12)
    both = df.unionByName(df.select((-F.col("v")).alias("v"))).unionByName(spark.createDataFrame([(0.0,), (float("inf"),), (float("-inf"),)], "v double"))
    want = both.agg(F.percentile("v", [0.1, 0.5, 0.9])).first()[0]
    assert Q.exact_values(both, "v", [0.1, 0.5, 0.9], band_limit=20, cells=16)[1] == pytest.approx(want, rel=1e-12)


def test_few_distinct_values_are_counted_and_many_banded(spark, monkeypatch):
    """The choice changes the plan, not the answer."""
    tied = spark.range(60_000).select((F.col("id") % 3).cast("string").alias("g"), F.pmod(F.xxhash64("id"), F.lit(500)).cast("double").alias("v"))
    distinct = spark.range(30_000).select((F.col("id") % 3).cast("string").alias("g"), (F.pmod(F.xxhash64("id"), F.lit(10**12)) / 7).alias("v"))
    banded = []
    real = Q._final_pass
    monkeypatch.setattr(Q, "_final_pass", lambda *a, **k: banded.append(1) or real(*a, **k))
    for df, counts in ((tied, True), (distinct, False)):
        for by in ([], ["g"]):
            banded.clear()
            _check(df, by, value_limit=2_000)
            assert (not banded) == counts
            _check(df, by, value_limit=0)
            assert banded
    mixed = tied.withColumn("g", F.lit("few")).unionByName(distinct.withColumn("g", F.lit("many")))
    banded.clear()
    _check(mixed, ["g"], value_limit=2_000)
    assert banded


def test_value_counting_takes_nulls_nan_empty_and_extra(spark):
    rows = [("a", 1.0), ("a", 1.0), ("a", float("nan")), ("b", None), (None, 3.0), (None, 5.0)]
    df = _frame(spark, rows)
    got = {r["g"]: tuple(r)[1:] for r in Q.quantile_table(df, "v", [0.5], ["g"], names=["m"], extra={"rows": F.count("*")}, value_limit=100)[0].collect()}
    assert got == {"a": (2, 1.0, 3), "b": (0, None, 1), None: (2, 4.0, 2)}
    assert Q.exact_values(df, "v", [0.5], value_limit=100) == (4, [2.0])
    assert Q.exact_values(df.limit(0), "v", [0.5], value_limit=100) == (0, [None])
    assert Q.quantiles(df.limit(0), "v", [0.5], ["g"], value_limit=100).collect() == []
