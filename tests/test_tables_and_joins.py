"""Crosstabs with awkward values, chi-square corrections, joins by bytes, NaN and names."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.operators import eda, ingest, stats
from quarry.operators.joins import byte_size, join_small, sized_side
from quarry.session import kept_scope

DAY = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("values,kind", [
    (["Yes", "yes", "a`b", "a", None], "string"), ([0.0001, 1e22, 2.5], "double"), ([DAY, DAY + dt.timedelta(seconds=1)], "timestamp")])
def test_crosstab_values_stay_data(spark, values, kind):
    rows = [(f"g{k % 3}", v) for k, v in enumerate(values * 3) if k != 1]
    df = spark.createDataFrame(rows, f"a string, b {kind}")
    want = {}
    for r in rows:
        want[r] = want.get(r, 0) + 1
    assert {(r["a"], r["b"]): r["count"] for r in eda.crosstab_long(df, "a", "b").collect()} == want
    full = {(r["a"], r["b"]): r["count"] for r in eda.crosstab_long(df, "a", "b", complete=True).collect()}
    known = [v for v in values if v is not None]
    assert full == {(a, b): want.get((a, b), 0) for a in ("g0", "g1", "g2") for b in known} | {k: n for k, n in want.items() if k[1] is None}


def test_crosstab_has_no_cap(spark):
    df = spark.range(12_000).select(F.lit("x").alias("a"), F.col("id").alias("b"))
    assert eda.crosstab_long(df, "a", "b", complete=True).count() == 12_000
    assert stats.chi_square(df, "a", "b", correction=True).first()["dof"] == 0


def yates(cells):
    a, b, c, d = cells
    n = sum(cells)
    out = 0.0
    for o, r, k in ((a, a + b, a + c), (b, a + b, b + d), (c, c + d, a + c), (d, c + d, b + d)):
        e = r * k / n
        out += max(abs(o - e) - 0.5, 0) ** 2 / e
    return out


@pytest.mark.parametrize("cells", [(5, 3, 2, 9), (5, 3, 0, 9), (4, 0, 0, 7), (1, 1, 1, 1)])
def test_yates(spark, cells):
    rows = [(i, j) for (i, j), n in zip([(0, 0), (0, 1), (1, 0), (1, 1)], cells) for _ in range(n)]
    got = stats.chi_square(spark.createDataFrame(rows, "a int, b int"), "a", "b", correction=True).first()
    assert got["statistic"] == pytest.approx(yates(cells))
    assert got["dof"] == 1


def test_chi_square_of_nothing(spark):
    got = stats.chi_square(spark.createDataFrame([], "a int, b int"), "a", "b").first()
    assert (got["statistic"], got["dof"], got["n"], got["p"]) == (None, 0, 0, None)


def test_wide_rows_are_not_broadcast(spark):
    small = spark.range(100).select("id", F.repeat(F.lit("x"), 500_000).alias("s"))
    assert byte_size(small) > 50_000_000
    assert sized_side(small)[1] is False
    assert sized_side(spark.range(100))[1] is True
    assert sized_side(spark.range(100), known_rows=100)[1] is True
    assert sized_side(spark.range(100), known_rows=10**9)[1] is False


@pytest.mark.parametrize("how", ["left", "right", "full", "inner"])
def test_enrich_keeps_keys(spark, how):
    fact = spark.createDataFrame([(1, "f1"), (None, "f0")], "k int, f string")
    dim = spark.createDataFrame([(1, "d1"), (2, "d2")], "k int, d string")
    got = {tuple(r) for r in ingest.enrich(fact, dim, "k", how=how).collect()}
    want = {(1, "f1", "d1")}
    want |= {(None, "f0", None)} if how in ("left", "full") else set()
    want |= {(2, None, "d2")} if how in ("right", "full") else set()
    assert got == want
    assert join_small(fact, dim, ["k"], how=how).count() == len(want)


def test_nan_is_null_everywhere(spark):
    df = spark.createDataFrame([(1.0, "g"), (float("nan"), "g"), (None, "g")], "`a.b` double, g string")
    assert [r["n_null"] for r in eda.profile_missing(df).collect()] == [2, 0]
    assert eda.profile_numeric(df, ["a.b"]).first()["n_null"] == 2
    assert eda.rate_by(df, ["g"], "a.b").first()["n"] == 1
    from quarry.operators.collect import group_stats

    got = group_stats(df.withColumnRenamed("a.b", "v"), ["g"], "v").first().asDict()
    assert got["total"] == 1.0 and got["max"] == 1.0 and got["n"] == 1


def test_correlation_of_one_column(spark):
    assert eda.correlation_pairs(spark.range(3), ["id"]).count() == 0


def test_csv_quarantine_header(spark, scratch):
    import os

    from quarry.sources.files import read_with_quarantine

    folder = os.path.join(scratch, "csv")
    os.makedirs(folder)
    for name, lines in (("a.csv", ["id,name", "1,x", "id,name", "2,y", "two,z"]), ("b.csv", ["id,name", "3,w"])):
        with open(os.path.join(folder, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    good, bad = read_with_quarantine(spark, folder, "id string, name string", "csv")
    assert sorted(tuple(r) for r in good.collect()) == [("1", "x"), ("2", "y"), ("3", "w"), ("id", "name"), ("two", "z")]
    good, bad = read_with_quarantine(spark, folder, "id int, name string", "csv")
    assert sorted(r["name"] for r in good.select("name").collect()) == ["w", "x", "y"]
    assert sorted(r["_raw"] for r in bad.collect()) == ["id,name", "two,z"]
    assert bad.count() == 2
    with open(os.path.join(folder, "c.csv"), "w") as f:
        f.write("NAME,ID\nx,1\n")
    with pytest.raises(Exception, match="header"):
        read_with_quarantine(spark, folder, "id int, name string", "csv")[0].collect()


def test_no_document_vanishes(spark, scratch):
    import json
    import os

    from quarry.plans import collect_job

    weather = [{"latitude": 1.0, "longitude": 2.0, "hourly": {"time": ["2024-01-01T00:00"], "temperature_2m": [3.0]}},
               {"latitude": 1.0, "longitude": 2.0}, {"latitude": "north", "longitude": 2.0, "hourly": {"time": [], "temperature_2m": []}},
               {"latitude": 1.0, "longitude": 2.0, "hourly": {"time": [], "temperature_2m": []}}, "{cut off"]
    countries = [{"code": "AA", "name": "A", "population": 1}, {"code": "BB", "name": "B", "population": "many"}, "["]
    ips = [{"query": "1", "status": "success", "countryCode": "AA"}, "nonsense", {"query": 5, "status": "success", "countryCode": "BB", "lat": "x"}]
    for name, docs in (("w", weather), ("c", countries), ("i", ips)):
        with open(os.path.join(scratch, name), "w") as f:
            f.writelines((d if isinstance(d, str) else json.dumps(d)) + "\n" for d in docs)
    out = os.path.join(scratch, "out")
    got = {(r["dataset"], r["status"]): r["rows"] for r in collect_job.run(
        spark, *[os.path.join(scratch, n) for n in "wci"], out).collect()}
    assert got == {("weather", "valid"): 1, ("weather", "rejected"): 4, ("countries", "valid"): 1, ("countries", "rejected"): 2,
                   ("locations", "valid"): 1, ("locations", "rejected"): 2}
    rejected = spark.read.parquet(f"{out}/weather").where("status = 'rejected'").collect()
    assert all(r["_raw"] and r["_reason"] and "sound_document" in r["errors"] for r in rejected)


def test_kept_scope_releases(spark):
    held = spark.sparkContext._jsc.getPersistentRDDs
    before = held().size()
    with kept_scope():
        eda.value_counts(spark.range(10), "id").collect()
        assert held().size() > before
    assert held().size() <= before
