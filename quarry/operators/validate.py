"""Validation of whole tables against a list of rules.

``validate`` adds ``errors: array<string>`` (names of broken rules, in rule
order); ``split_valid`` returns the valid and rejected parts as two lazy
DataFrames over the same expressions; ``write_split`` writes both in a single
pass; ``error_summary`` counts failures per rule in one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule

ERRORS = "errors"


def errors_column(rules: Sequence[Rule]):
    # concat of one-element or empty arrays, in rule order: unlike
    # array_compact (a lambda filter), concat keeps the projection inside
    # whole-stage codegen
    empty = F.array().cast("array<string>")
    if not rules:
        return empty
    return F.concat(*[F.when(r.bad, F.array(F.lit(r.name))).otherwise(empty) for r in rules])


def validate(df: DataFrame, rules: Sequence[Rule], column: str = ERRORS) -> DataFrame:
    return df.withColumn(column, errors_column(rules))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``; ``rejected`` keeps the ``errors`` column.

    Both are lazy and re-evaluate the rules from the source; to produce both
    from one read of a source that is expensive to parse use ``write_split``.
    """
    checked = validate(df, rules)
    valid = checked.where(F.size(ERRORS) == 0).drop(ERRORS)
    rejected = checked.where(F.size(ERRORS) > 0)
    return valid, rejected


def write_split(df: DataFrame, rules: Sequence[Rule], path: str, fmt: str = "parquet",
                mode: str = "errorifexists") -> None:
    """One pass: rows land under ``path/status=valid`` or ``path/status=rejected``."""
    checked = validate(df, rules).withColumn(
        "status", F.when(F.size(ERRORS) == 0, F.lit("valid")).otherwise(F.lit("rejected")))
    checked.write.mode(mode).format(fmt).partitionBy("status").save(path)


def error_summary(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rule_pos, rule, n_failed, n_rows``: one row per rule, zero counts kept."""
    if not rules:
        raise ValueError("no rules")
    counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                    *[F.count_if(r.bad).alias(f"__r{i}") for i, r in enumerate(rules)])
    stacked = F.inline(F.array(*[
        F.struct(F.lit(i).alias("rule_pos"), F.lit(r.name).alias("rule"),
                 F.col(f"__r{i}").alias("n_failed")) for i, r in enumerate(rules)]))
    return counts.select(stacked, F.col("__rows").alias("n_rows"))
