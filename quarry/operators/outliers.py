"""IQR outlier removal: bounds, filter, flag and a kept/dropped report.

Bounds are ``Q1 - k * IQR`` and ``Q3 + k * IQR`` (Tukey's fences, k = 1.5 by
default); a value on a bound is kept. A null (or NaN) value has no verdict:
``is_outlier`` is null and ``remove_outliers`` drops the row. A group without
any non-null value has null bounds.

Ungrouped, the single bounds row is read back and applied as literals, so the
range predicate reaches the Parquet scan (row-group skipping). Grouped, the
per-group bounds table is joined on the group keys with null-safe equality;
it is broadcast only when its counted size is under the session's limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import join_small
from .quantiles import QUARTILE_PROBS, clean_value, exact_values, quartile_table, quartiles


def iqr_bounds(df: DataFrame, col: str, k: float = 1.5, by: Sequence[str] | None = None,
               method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """``by..., n, q1, median, q3, iqr, lower, upper``."""
    return iqr_bounds_table(df, col, k, by, method, accuracy)[0]


def iqr_bounds_table(df: DataFrame, col: str, k: float = 1.5, by: Sequence[str] | None = None,
                     method: str = "exact", accuracy: int = 10000) -> tuple[DataFrame, int | None]:
    """``iqr_bounds`` and its row count when known (one row per group)."""
    by = list(by or [])
    q, rows = quartile_table(df, col, by, method, accuracy)
    iqr = F.col("q3") - F.col("q1")
    return q.select(*by, "n", "q1", "median", "q3", iqr.alias("iqr"),
                    (F.col("q1") - F.lit(k) * iqr).alias("lower"),
                    (F.col("q3") + F.lit(k) * iqr).alias("upper")), rows


def bound_values(df: DataFrame, col: str, k: float = 1.5, method: str = "exact",
                 accuracy: int = 10000) -> tuple[float | None, float | None]:
    """Ungrouped ``(lower, upper)`` as Python values, to be used as literals."""
    if method == "exact":
        _, (q1, _, q3) = exact_values(df, col, QUARTILE_PROBS, accuracy)
    else:
        row = quartiles(df, col, None, method, accuracy).first()
        q1, q3 = row["q1"], row["q3"]
    if q1 is None or q3 is None:
        return None, None
    iqr = q3 - q1
    return q1 - k * iqr, q3 + k * iqr


def _with_bounds(df: DataFrame, col: str, k: float, by: list[str], method: str,
                 accuracy: int, bounds: DataFrame | None) -> DataFrame:
    if not by:
        if bounds is not None:
            row = bounds.select("lower", "upper").first()
            lo, hi = (row["lower"], row["upper"]) if row is not None else (None, None)
        else:
            lo, hi = bound_values(df, col, k, method, accuracy)
        return df.withColumn("__lower", F.lit(lo).cast("double")).withColumn(
            "__upper", F.lit(hi).cast("double"))
    b, rows = (bounds, None) if bounds is not None else iqr_bounds_table(df, col, k, by, method, accuracy)
    side = b.select(*by, F.col("lower").alias("__lower"), F.col("upper").alias("__upper"))
    return join_small(df, side, by, how="left", known_rows=rows)


def flag_outliers(df: DataFrame, col: str, k: float = 1.5, by: Sequence[str] | None = None,
                  method: str = "exact", accuracy: int = 10000,
                  bounds: DataFrame | None = None) -> DataFrame:
    """All input rows plus boolean ``is_outlier`` (null for a null value)."""
    by = list(by or [])
    j = _with_bounds(df, col, k, by, method, accuracy, bounds)
    flag = ~clean_value(col).between(F.col("__lower"), F.col("__upper"))
    return j.withColumn("is_outlier", flag).drop("__lower", "__upper")


def remove_outliers(df: DataFrame, col: str, k: float = 1.5, by: Sequence[str] | None = None,
                    method: str = "exact", accuracy: int = 10000,
                    bounds: DataFrame | None = None) -> DataFrame:
    """Rows whose value lies inside its group's bounds, bounds included."""
    by = list(by or [])
    if not by:
        if bounds is not None:
            row = bounds.select("lower", "upper").first()
            lo, hi = (row["lower"], row["upper"]) if row is not None else (None, None)
        else:
            lo, hi = bound_values(df, col, k, method, accuracy)
        if lo is None:
            return df.limit(0)
        # Literal bounds: pushed down to the scan as two range filters.
        return df.where(F.col(col).between(F.lit(lo), F.lit(hi)))
    j = _with_bounds(df, col, k, by, method, accuracy, bounds)
    return j.where(clean_value(col).between(F.col("__lower"), F.col("__upper"))).drop(
        "__lower", "__upper")


def outlier_report(df: DataFrame, col: str, k: float = 1.5, by: Sequence[str] | None = None,
                   method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """``by..., n_rows, n_kept, n_outliers, n_null, lower, upper`` per group."""
    by = list(by or [])
    j = _with_bounds(df, col, k, by, method, accuracy, None)
    inside = clean_value(col).between(F.col("__lower"), F.col("__upper"))
    return j.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(inside).alias("n_kept"),
        F.count_if(~inside).alias("n_outliers"),
        F.count_if(inside.isNull()).alias("n_null"),
        F.max("__lower").alias("lower"),
        F.max("__upper").alias("upper"))
