"""Validation rules compiled to Column expressions.

A rule is a name and a boolean ``bad`` Column that is true when a row breaks
it. Rules never yield null: a null value fails only ``required`` (and never
``typed``, as there is nothing to cast); every other rule treats a null
predicate as passing. Because rules are plain Columns they run inside
whole-stage codegen, in one pass over the table, on batch and stream alike.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a decimal number as written in text files (sign, digits,
# optional fraction, optional exponent). Used so that "5d" or "1_000" is not
# accepted as a double.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"


@dataclass(frozen=True)
class Rule:
    name: str
    bad: Column

    def passes(self) -> Column:
        return ~self.bad


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _label(kind: str, col: str | Column, name: str | None) -> str:
    if name:
        return name
    return f"{kind}:{col}" if isinstance(col, str) else kind


def _never_null(pred_bad: Column) -> Column:
    return F.coalesce(pred_bad, F.lit(False))


def typed(col: str | Column, type_: str, name: str | None = None) -> Rule:
    """The raw value must convert to ``type_``; a null raw value passes."""
    raw = _c(col)
    text = raw.cast("string")
    cast_fails = raw.isNotNull() & raw.try_cast(type_).isNull()
    t = type_.lower()
    if t in ("double", "float") or t.startswith("decimal"):
        cast_fails = cast_fails | (raw.isNotNull() & ~text.rlike(NUMBER_PATTERN))
    elif t in ("int", "integer", "bigint", "long", "smallint", "tinyint"):
        cast_fails = cast_fails | (raw.isNotNull() & ~text.rlike(INTEGER_PATTERN))
    return Rule(_label(f"typed_{t}", col, name), _never_null(cast_fails))


def required(col: str | Column, name: str | None = None) -> Rule:
    return Rule(_label("required", col, name), _c(col).isNull())


def in_range(col: str | Column, lo=None, hi=None, name: str | None = None) -> Rule:
    """``lo <= value <= hi``; either end may be None (open)."""
    c = _c(col)
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (c >= F.lit(lo))
    if hi is not None:
        ok = ok & (c <= F.lit(hi))
    return Rule(_label("in_range", col, name), _never_null(~ok))


def one_of(col: str | Column, values: Iterable, name: str | None = None) -> Rule:
    return Rule(_label("one_of", col, name), _never_null(~_c(col).isin(list(values))))


def matches(col: str | Column, regex: str, name: str | None = None) -> Rule:
    """Java regex, searched (anchor with ^...$ for a full match)."""
    return Rule(_label("matches", col, name), _never_null(~_c(col).rlike(regex)))


def check(name: str, predicate: Column) -> Rule:
    """Any boolean Column, across columns; null counts as passing."""
    return Rule(name, _never_null(~predicate))
