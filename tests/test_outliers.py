"""IQR bounds, removal, flags and the report on the measures fixture."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarry.operators import outliers as O

# Fixture "measures": null v, NaN v, null g, constant group, one-row group,
# all-null group, a value exactly on a bound.
MEASURES = [
    ("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("a", 100.0), ("a", None), ("a", float("nan")),
    ("a", 8.5),
    ("c", 5.0), ("c", 5.0), ("c", 5.0),
    ("one", 9.0),
    ("nulls", None), ("nulls", None),
    (None, 1.0), (None, 2.0), (None, 3.0), (None, 4.0), (None, 50.0),
]


@pytest.fixture
def measures(spark):
    return spark.createDataFrame(MEASURES, "g string, v double")


def test_flag_partitions_rows(measures):
    f = O.flag_outliers(measures, "v", by=["g"])
    assert f.count() == len(MEASURES)
    c = f.groupBy("is_outlier").count().collect()
    assert sum(r["count"] for r in c) == len(MEASURES)
    # removal equals the rows flagged false
    kept = O.remove_outliers(measures, "v", by=["g"])
    assert kept.count() == f.where(F.col("is_outlier") == False).count()  # noqa: E712


def test_group_semantics(measures):
    b = {r["g"]: r for r in O.iqr_bounds(measures, "v", by=["g"]).collect()}
    assert b["nulls"]["lower"] is None and b["nulls"]["n"] == 0
    assert b["c"]["lower"] == b["c"]["upper"] == 5.0
    assert b["one"]["q1"] == b["one"]["q3"] == 9.0
    assert None in b                      # the null group is its own group
    f = {(r["g"], r["v"]): r["is_outlier"] for r in O.flag_outliers(measures, "v", by=["g"]).collect()
         if r["v"] is None or r["v"] == r["v"]}
    assert f[("a", 100.0)] is True
    assert f[("c", 5.0)] is False         # on both bounds: kept
    assert f[("a", None)] is None
    assert f[(None, 50.0)] is True        # null key not lost


def test_value_on_bound_is_kept(spark):
    # 9 values: q1 at rank 2 = 2, q3 at rank 6 = 4, iqr = 2 -> bounds -1 and 7
    vals = [-1.0, 2.0, 2.0, 2.0, 3.0, 4.0, 4.0, 4.0, 7.0]
    df = spark.createDataFrame([(x,) for x in vals], "v double")
    assert O.bound_values(df, "v") == (-1.0, 7.0)
    assert O.remove_outliers(df, "v").count() == 9          # both ends included
    df2 = spark.createDataFrame([(x,) for x in vals[:-1] + [7.0000001]], "v double")
    assert O.remove_outliers(df2, "v").count() == 8


def test_nan_dropped_ungrouped(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,), (3.0,)], "v double")
    assert O.remove_outliers(df, "v").count() == 3
    f = O.flag_outliers(df, "v").collect()
    assert sum(1 for r in f if r["is_outlier"] is None) == 2


def test_empty(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert O.remove_outliers(df, "v").count() == 0
    assert O.remove_outliers(df, "v", by=["g"]).count() == 0
    assert O.flag_outliers(df, "v").count() == 0


def test_report_counts(measures):
    r = {x["g"]: x for x in O.outlier_report(measures, "v", by=["g"]).collect()}
    for x in r.values():
        assert x["n_kept"] + x["n_outliers"] + x["n_null"] == x["n_rows"]
    assert r["a"]["n_outliers"] >= 1 and r["nulls"]["n_null"] == 2


@pytest.mark.parametrize("method", ["exact", "approx", "percentile"])
def test_methods_agree_on_events(spark, method):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    kept = O.remove_outliers(ev, "value", by=["event_type"], method=method)
    counts = {r["event_type"]: r["count"] for r in kept.groupBy("event_type").count().collect()}
    if method != "approx":
        assert counts == {"click": 1907, "error": 1927, "purchase": 1886, "signup": 1918, "view": 1891}
    assert O.remove_outliers(ev, "value", method=method).count() in (
        (9537,) if method != "approx" else tuple(range(9400, 9700)))
