"""Aggregation, comprehensions and generators over rows and arrays.

The Python idioms (a dict of lists, ``[f(x) for x in xs if p(x)]``, a
generator yielding many items per input) map onto Spark as follows:

* aggregation by key          -> ``groupBy().agg`` (partial aggregation map-side)
* comprehension over rows     -> ``where`` + ``select``
* comprehension inside a row  -> higher-order functions ``filter`` / ``transform`` / ``aggregate``
* generator, one row to many  -> ``explode`` / ``posexplode`` (a Python UDTF only when no expression can say it)
* generator over batches      -> ``mapInPandas``, whose function takes an iterator and yields
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordinal import running_before


def group_stats(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """``keys..., n, total, mean, min, max`` of ``col`` (nulls ignored, NaN counts as null)."""
    c = F.col(col)
    if dict(df.dtypes).get(col) in ("double", "float"):
        c = F.nanvl(c, F.lit(None))
    return df.groupBy(*keys).agg(F.count(c).alias("n"), F.sum(c).alias("total"),
                                 F.avg(c).alias("mean"), F.min(c).alias("min"),
                                 F.max(c).alias("max"))


def collect_by_key(df: DataFrame, key: str | Sequence[str], col: str,
                   distinct: bool = False) -> DataFrame:
    """``key..., items``: the values of ``col`` per key as a sorted array.

    The output row holds the whole list of its key, so this is for keys with a
    bounded number of values (dimension-like data); for counts or statistics
    per key use ``group_stats``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    agg = F.collect_set(col) if distinct else F.collect_list(col)
    return df.groupBy(*keys).agg(F.array_sort(agg).alias("items"))


def collect_chunks(df: DataFrame, key: str | Sequence[str], col: str, size: int = 10_000) -> DataFrame:
    """``key..., chunk, items``: the values of ``col`` per key in sorted arrays of at most ``size``, chunks numbered from 0.

    Joined in order, a key's chunks are the list of ``collect_by_key``: nulls are left out, equal values stay. A value's place is an ordinal over range
    partitions of the distinct values, so a key may have any number of values, also one value any number of times.
    """
    keys = [key] if isinstance(key, str) else list(key)
    counts = df.where(F.col(f"`{col}`").isNotNull()).groupBy(*keys, F.col(f"`{col}`").alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    placed = running_before(counts, [F.asc("__v")], F.col("__c"), keys, name="__first")
    first, last = F.floor(F.col("__first") / size), F.floor((F.col("__first") + F.col("__c") - 1) / size)
    cut = placed.withColumn("chunk", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))))
    n = F.least(F.col("__first") + F.col("__c"), (F.col("chunk") + 1) * size) - F.greatest(F.col("__first"), F.col("chunk") * size)
    runs = cut.groupBy(*keys, "chunk").agg(F.array_sort(F.collect_list(F.struct("__v", n.cast("int").alias("__n")))).alias("__r"))
    return runs.select(*keys, "chunk", F.flatten(F.transform("__r", lambda r: F.array_repeat(r["__v"], r["__n"]))).alias("items"))


def comprehend(df: DataFrame, where: Column | None = None, **exprs: Column) -> DataFrame:
    """``[ {name: expr(row)} for row in df if where(row) ]``."""
    out = df if where is None else df.where(where)
    return out.select(*[e.alias(n) for n, e in exprs.items()]) if exprs else out


def array_comprehension(arr: str | Column, keep: Callable[[Column], Column] | None = None,
                        f: Callable[[Column], Column] | None = None) -> Column:
    """``[f(x) for x in arr if keep(x)]`` as one expression."""
    a = F.col(arr) if isinstance(arr, str) else arr
    if keep is not None:
        a = F.filter(a, keep)
    if f is not None:
        a = F.transform(a, f)
    return a


def fold(arr: str | Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Left fold over an array (``functools.reduce`` with a start value)."""
    return F.aggregate(F.col(arr) if isinstance(arr, str) else arr, zero, step)


def generate_rows(df: DataFrame, arr: Column, keep: Sequence[str], name: str = "item",
                  position: str | None = None) -> DataFrame:
    """One output row per element of ``arr`` (a generator over each row)."""
    if position:
        return df.select(*keep, F.posexplode(arr).alias(position, name))
    return df.select(*keep, F.explode(arr).alias(name))


def tokens(text: str | Column, pattern: str = r"[ \t\n\r]+") -> Column:
    """Whitespace tokens of a text, empty tokens removed."""
    t = F.col(text) if isinstance(text, str) else text
    # array_remove, not a lambda filter: it stays inside whole-stage codegen
    return F.array_remove(F.split(t, pattern), "")


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame | None],
                schema: str) -> DataFrame:
    """Run ``fn`` on each Arrow batch as a generator pipeline (``mapInPandas``).

    ``fn`` must depend only on the rows of its batch, so the result does not
    depend on how Spark cut the data into partitions and batches.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = fn(pdf)
            if out is not None and len(out):
                yield out
    return df.mapInPandas(run, schema)
