"""The small tables behind exploratory charts, computed where the data is.

Each function returns a table sized by its parameters or by the number of
distinct values, never by the number of rows: profiles and correlations are one
aggregate pass, counts are partial aggregates, quartiles use the distributed
exact quantiles of ``quantiles``. Drawing is left to the caller.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import keep
from .joins import join_small
from .outliers import iqr_bounds_table
from .quantiles import QUARTILE_NAMES, QUARTILE_PROBS, clean_value, exact_values_wide, quantile_table


def _stack(df: DataFrame, items: list[tuple[str, list]], names: list[str]) -> DataFrame:
    """Turn one wide row into one row per item: ``[(label, [col exprs])]``."""
    structs = [F.struct(F.lit(label).alias(names[0]),
                        *[e.alias(n) for e, n in zip(exprs, names[1:])]) for label, exprs in items]
    return df.select(F.inline(F.array(*structs)))


def profile_numeric(df: DataFrame, cols: Sequence[str], method: str = "exact") -> DataFrame:
    """One row per column: ``column, n, n_null, mean, stddev, min, q1, median, q3, max``.

    ``stddev`` is the sample standard deviation. NaN counts as null. The exact method
    reads the input in three passes whatever the number of columns (wide sketch,
    counts below the bands, values inside them); the others group a long form.
    """
    cols = list(cols)
    if method == "exact" and cols:
        values = [F.col(f"`{c}`") for c in cols]
        v = [clean_value(c) for c in values]
        extra = [{"n_null": F.count_if(c.isNull()), "mean": F.avg(c), "stddev": F.stddev_samp(c), "min": F.min(c), "max": F.max(c)} for c in v]
        rows = [(c, n, x["n_null"], x["mean"], x["stddev"], x["min"], *q, x["max"])
                for c, (n, q, x) in zip(cols, exact_values_wide(df, values, QUARTILE_PROBS, extra))]
        return df.sparkSession.createDataFrame(
            rows, "column string, n long, n_null long, mean double, stddev double, min double, q1 double, median double, q3 double, max double")
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"),
                                                 clean_value(F.col(f"`{c}`")).alias("value")) for c in cols])))
    v = F.col("value")
    extra = {"n_null": F.count_if(v.isNull()), "mean": F.avg(v), "stddev": F.stddev_samp(v),
             "min": F.min(v), "max": F.max(v)}
    q, _ = quantile_table(long, "value", QUARTILE_PROBS, by=["column"], method=method,
                          names=QUARTILE_NAMES, extra=extra)
    # every requested column gets its row, also for an empty table
    grid = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    out = join_small(grid, q, ["column"], how="left", known_rows=len(cols))
    return out.select("column", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
                      F.coalesce("n_null", F.lit(0)).cast("long").alias("n_null"),
                      "mean", "stddev", "min", "q1", "median", "q3", "max")


def profile_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``column, n_rows, n_null, null_share`` for every column (NaN counts as null, as in ``profile_numeric``)."""
    cols = list(cols or df.columns)
    kinds = dict(df.dtypes)

    def missing(c: str) -> Column:
        v = F.col(f"`{c}`")
        return v.isNull() | F.isnan(v) if kinds[c] in ("double", "float") else v.isNull()

    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(missing(c)).alias(f"__null{i}") for i, c in enumerate(cols)])
    out = _stack(wide, [(c, [F.col("__rows"), F.col(f"__null{i}")]) for i, c in enumerate(cols)],
                 ["column", "n_rows", "n_null"])
    return out.withColumn("null_share", F.when(F.col("n_rows") > 0,
                                               F.col("n_null") / F.col("n_rows")))


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """``<col>, count, share`` by descending count, ties by value; top ``n`` if given."""
    # the input is read once: the total is summed from the kept counts
    counts = keep(df.groupBy(col).agg(F.count(F.lit(1)).alias("count")))
    total = counts.agg(F.sum("count")).scalar()
    out = counts.withColumn("share", F.col("count") / total)
    out = out.orderBy(F.col("count").desc(), F.col(col).asc_nulls_last())
    return out.limit(n) if n is not None else out


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """``bin, lower, upper, count`` for ``bins`` equal bins over ``[lo, hi]``.

    The last bin is closed; values outside ``[lo, hi]`` (and nulls) are left
    out; every bin is returned, empty ones with count 0.
    """
    if bins < 1 or not hi > lo:
        raise ValueError("need bins >= 1 and hi > lo")
    width = (hi - lo) / bins
    v = clean_value(col)
    b = F.least(F.floor((v - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("long")
    counts = (df.where(v.between(lo, hi)).groupBy(b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("count")))
    spark = df.sparkSession
    grid = spark.range(bins).select(F.col("id").alias("bin"))
    out = join_small(grid, counts, ["bin"], how="left", known_rows=bins)
    return out.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
                      F.coalesce(F.col("count"), F.lit(0)).alias("count"))


def box_stats(df: DataFrame, col: str, by: Sequence[str] | None = None, k: float = 1.5,
              method: str = "exact") -> DataFrame:
    """``by..., n, q1, median, q3, lower_whisker, upper_whisker, n_outliers``.

    Whiskers are the most extreme values inside the IQR bounds.
    """
    by = list(by or [])
    b, rows = iqr_bounds_table(df, col, k, by, method)
    v = clean_value(col)
    if by:
        j = join_small(df.select(*by, v.alias("__v")),
                       b.select(*by, "n", "q1", "median", "q3", "lower", "upper"), by, known_rows=rows)
    else:
        row = b.first()
        j = df.select(v.alias("__v"), *[F.lit(row[c]).alias(c) for c in
                                       ("n", "q1", "median", "q3", "lower", "upper")])
    inside = F.col("__v").between(F.col("lower"), F.col("upper"))
    return j.groupBy(*by, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("__v"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("__v"))).alias("upper_whisker"),
        F.count_if(~inside).alias("n_outliers"))


#: Columns up to which each pair is an aggregate expression of one generated plan.
MOST_EXPRESSIONS = 24


def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``col_a, col_b, corr`` (Pearson) for every pair, one aggregate pass; no rows for fewer than two columns.

    A pair is taken over the rows where both have a value. More than ``MOST_EXPRESSIONS`` columns go through
    :func:`gram_correlations`, as a plan of their square would not be compiled.
    """
    pairs = list(combinations(list(cols), 2))
    if len(cols) > MOST_EXPRESSIONS:
        return gram_correlations(df, cols)
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    wide = df.agg(*[F.corr(clean_value(F.col(f"`{a}`")), clean_value(F.col(f"`{b}`"))).alias(f"__corr{i}") for i, (a, b) in enumerate(pairs)])
    structs = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                        F.col(f"__corr{i}").alias("corr")) for i, (a, b) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*structs)))


def gram_correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """As :func:`correlation_pairs` for many columns: products of matrices inside the tasks, one pass after the means.

    A task adds up four Gram matrices of its values less the columns' means (rows that both have, sums, squares, products)
    and passes each column's rows of them on; a column's sums from all tasks meet in one place. Null where fewer than two rows have both, or a
    column does not vary over these.
    """
    cols = list(cols)
    values = [clean_value(F.col(f"`{c}`")) for c in cols]
    means = [m or 0.0 for m in df.agg(*[F.avg(v) for v in values]).first()]
    shifted = df.select(*[(v - F.lit(m)).alias(f"v{i}") for i, (v, m) in enumerate(zip(values, means, strict=True))])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, len(cols), len(cols)))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1)
            known = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x, nan=0.0)
            total += [known.T @ known, x.T @ known, (x * x).T @ known, x.T @ x]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cols))), pa.array([total[:, k].tobytes() for k in range(len(cols))], pa.binary())],
                                         names=["a", "sums"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for a, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[a] = sums.get(a, 0) + np.frombuffer(own).reshape(4, len(cols))
        for a, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cols), a)), pa.array(np.arange(len(cols))), *map(pa.array, own)],
                                             names=["a", "b", "n", "s", "q", "p"])

    # Without rows there are no tasks: every pair is there all the same.
    none = df.sparkSession.range(len(cols)).select(F.col("id").alias("a"), F.lit(bytes(32 * len(cols))).alias("sums"))
    long = shifted.mapInArrow(partial, "a long, sums binary").unionByName(none).repartition("a").mapInArrow(
        whole, "a long, b long, n double, s double, q double, p double")
    other = long.select(F.col("a").alias("b"), F.col("b").alias("a"), F.col("s").alias("s2"), F.col("q").alias("q2"))
    n, c = F.col("n"), F.col
    spread = (c("q") - c("s") * c("s") / n) * (c("q2") - c("s2") * c("s2") / n)
    named = F.array(*[F.lit(x) for x in cols])
    return long.where("a < b").join(other, ["a", "b"]).select(
        F.get(named, c("a").cast("int")).alias("col_a"), F.get(named, c("b").cast("int")).alias("col_b"),
        F.when((n >= 2) & (spread > 0), (c("p") - c("s") * c("s2") / n) / F.sqrt(spread)).alias("corr"))


def crosstab_long(df: DataFrame, a: str, b: str, complete: bool = False) -> DataFrame:
    """``a, b, count, row_share, col_share``.

    Shares are within the row (all cells with the same ``a``) and within the
    column. Values stay data, of any type and in any number. ``complete`` adds the
    zero cells of the non-null values: the output is then one row per pair of
    values by definition, made from the two margins inside Spark.
    """
    ca, cb = F.col(f"`{a}`"), F.col(f"`{b}`")
    counts = keep(df.groupBy(ca.alias("__a"), cb.alias("__b")).agg(F.count(F.lit(1)).alias("count")))
    rows = counts.groupBy("__a").agg(F.sum("count").alias("__rt"))
    cols = counts.groupBy("__b").agg(F.sum("count").alias("__ct"))
    if complete:
        grid = rows.where(F.col("__a").isNotNull()).crossJoin(cols.where(F.col("__b").isNotNull()))
        seen = counts.withColumnsRenamed({"__a": "__ca", "__b": "__cb"})
        match = F.col("__a").eqNullSafe(F.col("__ca")) & F.col("__b").eqNullSafe(F.col("__cb"))
        full = grid.join(seen, match, "left").select("__a", "__b", F.coalesce("count", F.lit(0)).cast("long").alias("count"), "__rt", "__ct")
        nulls = counts.where(F.col("__a").isNull() | F.col("__b").isNull())
        j = full.unionByName(join_small(join_small(nulls, rows, ["__a"]), cols, ["__b"]))
    else:
        # Margins as aggregates joined back (broadcast where measured small), so a
        # category with very many cells is not gathered into one window task.
        j = join_small(join_small(counts, rows, ["__a"]), cols, ["__b"])
    return j.select(F.col("__a").alias(a), F.col("__b").alias(b), "count", (F.col("count") / F.col("__rt")).alias("row_share"),
                    (F.col("count") / F.col("__ct")).alias("col_share"))


def cell_counts(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    """``column, value, <by>, count``: cells of several columns against ``by``, one pass.

    Values are read as text. Partial aggregates combine before the shuffle.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols])
    return df.select(F.inline(pairs), F.col(f"`{by}`")).groupBy("column", "value", by).agg(F.count(F.lit(1)).alias("count"))


def rate_by(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """``keys..., n, n_flag, rate``: share of rows with a true/1 flag per segment."""
    f = clean_value(F.col(f"`{flag}`"))  # NaN counts as null, as everywhere here
    return df.groupBy(*keys).agg(F.count(f).alias("n"),
                                 F.sum(f).cast("long").alias("n_flag"),
                                 F.avg(f).alias("rate"))
