"""Plan shapes the design relies on at scale, read from ``explain("formatted")``."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from quarry import registry
from quarry.operators.joins import join_small

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_ungrouped_bounds_reach_the_scan(spark):
    p = _plan(registry.QUERIES["iqr_remove"](spark, SF))
    assert "GreaterThanOrEqual(value," in p and "LessThanOrEqual(value," in p
    assert "Join" not in p and "Exchange" not in p


def test_quantile_scan_reads_one_column(spark):
    p = _plan(registry.QUERIES["quartiles_grouped"](spark, SF))
    assert "ReadSchema: struct<event_type:string,value:double>" in p


def test_grouped_bounds_and_dimensions_are_broadcast(spark):
    assert "BroadcastHashJoin" in _plan(registry.QUERIES["iqr_remove_grouped"](spark, SF))
    p = _plan(registry.QUERIES["enrich_join"](spark, SF))
    assert p.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in p


def test_validation_is_one_projection(spark):
    p = _plan(registry.QUERIES["validate_errors"](spark, SF))
    # one scan and one projection, inside whole-stage codegen ("*")
    assert "Exchange" not in p and "* Project" in p


def test_aggregates_are_partial(spark):
    p = _plan(registry.QUERIES["group_stats"](spark, SF))
    assert "partial_count" in p and "partial_sum" in p


def test_over_limit_side_is_not_broadcast(spark):
    big = spark.read.parquet(f"{SF}/customer.parquet")
    small = spark.read.parquet(f"{SF}/nation.parquet").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(join_small(big, small, ["c_nationkey"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
    p = _plan(join_small(big, small, ["c_nationkey"]))
    assert "BroadcastHashJoin" in p
