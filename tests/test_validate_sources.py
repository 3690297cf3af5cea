"""Rules, validation split, quarantine reads and declared-schema reads."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from quarry.functions import rules as R
from quarry.operators import validate as V
from quarry.sources import files as S

RECORD_SCHEMA = "id int, name string, email string, age int, score double"


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_rule_null_semantics(spark):
    df = spark.createDataFrame([(None, None), ("x", 5.0), ("5d", 200.0), ("2.5", -1.0)],
                               "raw string, v double")
    rules = [R.required("raw"), R.typed("raw", "double"), R.typed("raw", "int"),
             R.in_range("v", 0, 100), R.one_of("raw", ["x"]), R.matches("raw", "^[a-z]+$"),
             R.check("v_small", F.col("v") < 10)]
    out = {r["raw"]: r["errors"] for r in V.validate(df, rules).collect()}
    # a null fails only `required`
    assert out[None] == ["required:raw"]
    assert "typed_double:raw" in out["x"] and "typed_int:raw" in out["x"]
    # "5d" casts in Java but is not a number as written
    assert "typed_double:raw" in out["5d"] and "in_range:v" in out["5d"]
    # "2.5" is a double, not an int
    assert "typed_double:raw" not in out["2.5"] and "typed_int:raw" in out["2.5"]
    assert out["2.5"] == [e for e in ["typed_int:raw", "in_range:v", "one_of:raw",
                                      "matches:raw"] if e in out["2.5"]]  # rule order


def test_split_is_a_partition(spark):
    cust = spark.read.parquet("/root/testdata/sf0.01/customer.parquet")
    rules = [R.in_range("c_acctbal", 0, 9000), R.one_of("c_mktsegment", ["BUILDING"])]
    valid, rejected = V.split_valid(cust, rules)
    assert valid.count() + rejected.count() == cust.count()
    assert valid.join(rejected, "c_custkey").count() == 0
    summ = {r["rule"]: r["n_failed"] for r in V.error_summary(cust, rules).collect()}
    assert summ["one_of:c_mktsegment"] == cust.where("c_mktsegment <> 'BUILDING'").count()


def test_write_split_one_pass(spark, scratch):
    cust = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    out = os.path.join(scratch, "split")
    V.write_split(cust, [R.in_range("c_acctbal", 0, 5000)], out)
    back = spark.read.parquet(out)
    assert back.count() == cust.count()
    assert {r["status"] for r in back.select("status").distinct().collect()} == {"valid", "rejected"}


def test_quarantine_json(spark, scratch):
    p = _write(os.path.join(scratch, "records.jsonl"), "\n".join([
        '{"id": 1, "name": "a", "email": "a@x.org", "age": 30, "score": 1.5}',   # good
        '{"id": "two", "name": "b", "email": "b@x.org", "age": 31, "score": 2}',  # wrong type
        '{"id": 3, "name": "c"}',                                                # missing fields
        '{"id": 4, "name": null, "email": "d@x.org", "age": 5, "score": 0}',     # explicit null
        '{"id": 5, "name": "e", "email": "e@x.org", "age": 9, "score": 1, "x": 1}',  # extra field
        '{"id": 6, "name": "f"',                                                 # broken line
        '{"id": 7, "name": "g", "email": "g@x.org", "age": 999, "score": 1}',    # out of range
        '']))
    empty = _write(os.path.join(scratch, "empty.jsonl"), "")
    good, bad = S.read_with_quarantine(spark, [p, empty], RECORD_SCHEMA, "json")
    assert sorted(r["id"] for r in good.collect()) == [1, 3, 4, 5, 7]
    assert bad.count() == 2
    assert all(r["_file"].endswith("records.jsonl") for r in bad.collect())
    valid, rejected = V.split_valid(good, [R.required("name"), R.required("age"),
                                           R.in_range("age", 0, 130)])
    assert sorted(r["id"] for r in valid.collect()) == [1, 5]


def test_quarantine_csv(spark, scratch):
    p = _write(os.path.join(scratch, "records.csv"), "\n".join([
        "id,name,email,age,score",
        "1,a,a@x.org,30,1.5",
        "2,b,b@x.org",                      # short row
        "3,c,c@x.org,40,1.0,extra",         # long row
        '4,"d, jr",d@x.org,41,2.0',         # quoted comma
        "5,e,e@x.org,old,2.0",              # non-numeric
        ""]))
    good, bad = S.read_with_quarantine(spark, p, RECORD_SCHEMA, "csv")
    assert sorted(r["id"] for r in good.collect()) == [1, 4]
    assert [r["name"] for r in good.where("id = 4").collect()] == ["d, jr"]
    assert bad.count() == 3


def test_declared_schema_and_null_token(spark, scratch):
    p = _write(os.path.join(scratch, "adult.csv"), "\n".join([
        "39, State-gov, 77516, Bachelors",
        "50, ?, 83311, Bachelors",
        "38, Private, ?, HS-grad", ""]))
    df = S.read_with_null_token(spark, p, "age int, workclass string, fnlwgt int, education string")
    rows = df.orderBy("age").collect()
    assert rows[0]["fnlwgt"] is None and rows[2]["workclass"] is None
    assert rows[1]["workclass"] == "State-gov"
    out = os.path.join(scratch, "parq")
    S.write_table(df, out, partition_by=["education"])
    assert S.read_table(spark, out).count() == 3


def test_payloads(spark, scratch):
    p = _write(os.path.join(scratch, "countries.jsonl"),
               '{"code": "KR", "name": "Korea", "population": 51700000}\n'
               '{"code": "XX", "name": "Nowhere", "population": null}\nnot json\n')
    df = S.read_payloads(spark, p, "code string, name string, population bigint")
    rows = {r["code"]: r for r in df.collect()}
    assert rows["KR"]["_parsed"] and rows["XX"]["population"] is None
    assert sum(1 for r in rows.values() if not r["_parsed"]) == 1
