"""IQR outlier removal end to end: read, bound, filter, write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.outliers import remove_outliers
from ..sources.files import read_table, write_table


def run(spark: SparkSession, path: str, col: str, out: str | None = None,
        by: Sequence[str] | None = None, k: float = 1.5, fmt: str = "parquet",
        schema: str | None = None, method: str = "exact", mode: str = "errorifexists") -> DataFrame:
    """Rows of ``path`` inside their IQR bounds; written to ``out`` when given (and then read back)."""
    df = read_table(spark, path, fmt, schema)
    kept = remove_outliers(df, col, k=k, by=by, method=method)
    if out is not None:
        write_table(kept, out, fmt="parquet", mode=mode)
        return read_table(spark, out)
    return kept
