"""Joins against a small side whose size in bytes is checked, never assumed.

``join_small`` is the one place the library forces a broadcast: the small side
(an aggregate here: bounds, margins, a grid) is kept and its rows and bytes are
measured in one job, and it is broadcast only if it fits the session's
``spark.sql.autoBroadcastJoinThreshold``. A side made of fixed-width columns whose row count
is known needs no job. Beyond the limit the join is left to the planner
(sort-merge, with AQE splitting a hot key). Tables read from files carry their
own sizes and are joined without a hint (``join_kept_key``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_byte_limit, keep

_FIXED = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
          T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16}
ROW_OVERHEAD = 16


def _fixed_width(df: DataFrame) -> int | None:
    """Bytes of a row, or None where a column's width varies."""
    widths = [_FIXED.get(type(f.dataType)) for f in df.schema.fields]
    return None if any(w is None for w in widths) else sum(w + 8 for w in widths) + ROW_OVERHEAD


def byte_size(df: DataFrame) -> int:
    """Bytes of all rows, measured in one job."""
    size = F.lit(ROW_OVERHEAD)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        fixed = _FIXED.get(type(f.dataType))
        if fixed is not None:
            size = size + fixed + 8
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        else:
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
    return df.agg(F.sum(size.cast("long"))).first()[0] or 0


def sized_side(small: DataFrame, known_rows: int | None = None, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """``(side, broadcast?)``."""
    limit = broadcast_byte_limit(small.sparkSession) if max_bytes is None else max_bytes
    if limit <= 0:
        return small, False
    width = _fixed_width(small)
    if known_rows is not None and width is not None:
        fits = known_rows * width <= limit
    else:
        small = keep(small)  # the measuring job fills it
        fits = byte_size(small) <= limit
    return (F.broadcast(small), True) if fits else (small, False)


def _condition(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: bool) -> Column:
    cond: Column | None = None
    for k in on:
        a, b = left[f"`{k}`"], right[f"`__r_{k}`"]
        c = a.eqNullSafe(b) if null_safe else a == b
        cond = c if cond is None else cond & c
    return cond


def _join(big: DataFrame, renamed: DataFrame, on: list[str], how: str, null_safe: bool) -> DataFrame:
    out = big.join(renamed, _condition(big, renamed, on, null_safe), how)
    if how in ("right", "right_outer", "rightouter", "full", "outer", "full_outer", "fullouter"):
        # an unmatched row of the right side keeps its key
        names = [F.coalesce(F.col(f"`{c}`"), F.col(f"`__r_{c}`")).alias(c) if c in on else F.col(f"`{c}`") for c in big.columns]
        rest = [F.col(f"`{c}`") for c in renamed.columns if c not in {f"__r_{k}" for k in on}]
        return out.select(*names, *rest)
    return out.drop(*[f"__r_{k}" for k in on])


def _renamed(small: DataFrame, on: list[str]) -> DataFrame:
    return small.select(*[F.col(f"`{k}`").alias(f"__r_{k}") for k in on],
                        *[F.col(f"`{c}`") for c in small.columns if c not in on])


def join_small(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", null_safe: bool = True,
               known_rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Join ``big`` to a small side on ``on``, keeping one copy of each key.

    ``null_safe`` matches null keys to null keys (``<=>``), so a null group is
    not lost the way a plain equi-join loses it.
    """
    on = list(on)
    if not on:
        raise ValueError("join_small needs at least one key; use literals for one-row sides")
    side, _ = sized_side(_renamed(small, on), known_rows, max_bytes)
    return _join(big, side, on, how, null_safe)


def join_kept_key(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                  null_safe: bool = False) -> DataFrame:
    """Join without a hint: the planner and AQE know the sizes. Right and full joins keep the key."""
    on = list(on)
    return _join(left, _renamed(right, on), on, how, null_safe)
