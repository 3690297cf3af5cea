"""One long report table gathered from the analysis parts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ("section", "item", "metric", "value")


def long_part(df: DataFrame, section: str, ids: Sequence[str] = (),
              metrics: Sequence[str] | None = None) -> DataFrame:
    """``section, item, metric, value`` from a wide result table.

    ``item`` joins the id columns with ``|`` (``all`` when there are none);
    every metric is cast to double.
    """
    ids = list(ids)
    metrics = list(metrics or [c for c in df.columns if c not in ids])
    item = F.concat_ws("|", *[F.col(c).cast("string") for c in ids]) if ids else F.lit("all")
    wide = df.select(item.alias("item"), *[F.col(m).cast("double").alias(m) for m in metrics])
    long = wide.unpivot(["item"], metrics, "metric", "value")
    return long.select(F.lit(section).alias("section"), "item", "metric", "value")


def report_table(parts: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Union of parts given as ``{section: (table, id_columns)}``."""
    out = None
    for section, (df, ids) in parts.items():
        p = long_part(df, section, ids)
        out = p if out is None else out.unionByName(p)
    if out is None:
        raise ValueError("no report parts")
    return out
