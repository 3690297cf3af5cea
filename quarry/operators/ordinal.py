"""Ordinals and running sums in a global order, without a global window.

The rows are range-partitioned and sorted, so that each task holds a run of the
order; a partition's total is added up once (one row a partition and group), and
a row's sum is its partition's offset and the sum inside the partition. No task sees more
than a range partition, however many rows a group has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import join_small


def running_before(df: DataFrame, order: Sequence[Column], weight: Column | None = None, by: Sequence[str] = (),
                   name: str = "before") -> DataFrame:
    """``df`` with ``name``: the sum of ``weight`` (default 1) over the rows before it in ``order``, per group ``by``.

    Rows that tie in ``order`` come in any order, so make it unique. Null weights count
    as 0. A group may be null. The result's rows are those of ``df``.
    """
    by = list(by)
    keys = [F.col(f"`{c}`").asc_nulls_first() for c in by]
    weight = F.lit(1) if weight is None else F.coalesce(weight, F.lit(0))
    dealt = df.withColumn("__w", weight.cast("bigint")).repartitionByRange(*keys, *order)
    dealt = materialize(dealt.sortWithinPartitions(*keys, *order).withColumn("__part", F.spark_partition_id()))
    totals = dealt.groupBy(*by, "__part").agg(F.sum("__w").alias("__total"))
    parts = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("__offset", F.coalesce(F.sum("__total").over(parts), F.lit(0))).drop("__total")
    own = Window.partitionBy(*by, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("__inside", F.coalesce(F.sum("__w").over(own), F.lit(0)))
    out = join_small(inside, offsets, [*by, "__part"])
    return out.withColumn(name, F.col("__offset") + F.col("__inside")).drop("__w", "__part", "__offset", "__inside")
