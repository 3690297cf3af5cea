"""Match spans as columns, from Spark's own regular-expression functions.

``split`` and ``regexp_extract_all`` walk a text with the same leftmost,
non-overlapping matches, so the pieces between matches and the matches
themselves alternate, and summing their lengths gives code-point offsets.

An ``aggregate`` that appends to an array copies it at every step. ``scan`` therefore
walks an array in blocks of ``BLOCK`` and appends a whole block at a time, and ``part`` cuts a text's
surroundings from pieces of it, so a text with very many matches costs little more than its length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<s:int,e:int,kind:string,rank:int,m:string,score:double>>"
BLOCK = 256
PIECE = 512


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often a lambda in the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scan(items: Column, state: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """The arrays (of type ``kind``) that ``step(state, item) -> (next state, array)`` gives, joined in order."""
    none = F.array().cast(kind)

    def inner(acc: Column, x: Column) -> Column:
        after, out = step(acc["state"], x)
        return F.struct(after.alias("state"), F.concat(acc["out"], out).alias("out"))

    def outer(acc: Column, block: Column) -> Column:
        return F.aggregate(block, F.struct(acc["state"].alias("state"), none.alias("out")), inner, lambda own: F.struct(
            own["state"].alias("state"), F.concat(acc["out"], F.array(own["out"])).alias("out")))

    def whole(every: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(every) - 1) / BLOCK).cast("int")),
                             lambda k: F.slice(every, k * BLOCK + 1, BLOCK))
        start = F.struct(state.alias("state"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.when(F.size(every) > 0, F.aggregate(blocks, start, outer, lambda acc: F.flatten(acc["out"]))).otherwise(none)

    return let(items, whole)


def pieces(text: Column) -> Column:
    """The text in pieces of ``PIECE`` code points, for :func:`part`."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def part(cut: Column, start: Column, length: Column | int) -> Column:
    """``length`` (at most ``PIECE``) code points from ``start`` (from 0) of a text in :func:`pieces`."""
    k = F.floor(start / PIECE).cast("int")
    two = F.concat(F.coalesce(F.get(cut, k), F.lit("")), F.coalesce(F.get(cut, k + 1), F.lit("")))
    return F.substring(two, start - k * PIECE + 1, F.lit(length) if isinstance(length, int) else length)


def spans(text: Column, pattern: str, kind: str, rank: int, score: float = 1.0,
          guard: Column | None = None) -> Column:
    """All matches of ``pattern``, which never matches the empty string.

    ``guard`` is a cheap condition that every text with a match fulfils.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    none = F.array().cast(SPAN)

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        s = at + x["g"]
        e = s + F.coalesce(F.char_length(x["m"]), F.lit(0))
        one = F.struct(s.alias("s"), e.alias("e"), F.lit(kind).alias("kind"), F.lit(rank).alias("rank"),
                       x["m"].alias("m"), F.lit(score).cast("double").alias("score"))
        return e, F.when(x["m"].isNull(), none).otherwise(F.array(one).cast(SPAN))

    every = scan(F.arrays_zip(gaps.alias("g"), found.alias("m")), F.lit(0), step, SPAN)
    hit = text.rlike(pattern) if guard is None else guard & text.rlike(pattern)
    return F.when(hit, every).otherwise(none)


def joined(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined; empty if none."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def by_start(found: Column) -> Column:
    """Spans ordered by start, then by the rank of their kind, then by end."""
    def before(a: Column, b: Column) -> Column:
        less = (a["s"] < b["s"]) | ((a["s"] == b["s"]) & ((a["rank"] < b["rank"]) | (
            (a["rank"] == b["rank"]) & (a["e"] < b["e"]))))
        same = (a["s"] == b["s"]) & (a["rank"] == b["rank"]) & (a["e"] == b["e"])
        return F.when(less, F.lit(-1)).when(same, F.lit(0)).otherwise(F.lit(1))
    return F.array_sort(found, before)
