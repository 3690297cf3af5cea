"""Shaping landed API payloads: flatten parallel arrays, attach dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import join_kept_key

# Fixed value: ISO local date-time as the hourly weather payloads write it.
HOURLY_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"


def flatten_parallel(df: DataFrame, arrays: Sequence, names: Sequence[str],
                     keep: Sequence[str] = ()) -> DataFrame:
    """One row per position of parallel arrays (``zip(*arrays)`` as rows).

    Shorter arrays are padded with nulls; a row whose arrays are all null
    yields no rows.
    """
    cols = [F.col(a) if isinstance(a, str) else a for a in arrays]
    zipped = F.arrays_zip(*[c.alias(n) for c, n in zip(cols, names)])
    return df.select(*keep, F.inline(zipped))


def flatten_hourly(df: DataFrame, time_path: str, value_paths: Sequence[str],
                   keep: Sequence[str] = (), time_format: str = HOURLY_TIME_FORMAT,
                   names: Sequence[str] | None = None) -> DataFrame:
    """One row per time step from a payload holding parallel arrays.

    ``time_path`` and ``value_paths`` are struct paths such as
    ``hourly.time`` / ``hourly.temperature_2m``. Arrays of unequal length are
    padded with nulls (``arrays_zip``); a payload without the arrays yields no
    rows. ``time`` is parsed with ``time_format``; text that does not parse
    gives a null ``time`` and the raw text stays in ``time_text``.
    """
    names = list(names or [p.split(".")[-1] for p in value_paths])
    rows = flatten_parallel(df, [time_path, *value_paths], ["__t", *names], keep)
    return rows.select(*keep,
                       F.try_to_timestamp(F.col("__t"), F.lit(time_format)).cast("timestamp_ntz")
                       .alias("time"),
                       F.col("__t").alias("time_text"), *names)


def enrich(fact: DataFrame, dim: DataFrame, on: Sequence[str] | str, how: str = "left") -> DataFrame:
    """Attach dimension attributes; right and full joins keep an unmatched dimension row's key.

    No hint is given: a dimension read from files carries its size, and others
    are sized by AQE at run time.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return join_kept_key(fact, dim, keys, how=how)


HEAVY_KEYS = 1000
_TRACKED = 20_000


def _hashed(df: DataFrame, keys: Sequence[str]):
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def heavy_keys(fact: DataFrame, keys: Sequence[str], share: float) -> list[tuple[int, int]]:
    """``(hash of the key, times)`` of keys with more than ``share`` of the rows, from one mergeable sketch.

    ``times`` is how often the share fits into the key's rows, rounded up. The sketch tracks a bounded number of keys, so at
    most ``HEAVY_KEYS`` pairs reach the driver whatever the table. A key that it overestimates is salted in vain, no more.
    """
    known = fact.where(" and ".join(f"`{k}` is not null" for k in keys)).select(_hashed(fact, keys).alias("__k"))
    row = known.agg(F.expr(f"approx_top_k(__k, {HEAVY_KEYS}, {_TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    limit = max(1.0, share * row["n"])
    return [(r["item"], -(-r["count"] // int(limit) or 1)) for r in row["top"] or [] if r["item"] is not None and r["count"] > limit]


def enrich_salted(fact: DataFrame, dim: DataFrame, on: Sequence[str] | str, how: str = "left", pieces: int | None = None) -> DataFrame:
    """:func:`enrich` for a fact table with hot or unknown (null) keys: the same rows, without a task that gets a hot key whole.

    ``how``: inner, left, right or full. Keys with more than ``1 / pieces`` of the fact rows (default: eight times
    the session's shuffle partitions) are found by a heavy-hitter sketch. Their rows are dealt by a hash of the
    whole row into as many salts as that share fits into them, and their dimension rows are repeated for each, some
    ``2 * pieces`` repeats in all; null keys match nothing and are dealt alike. Dimension rows that match nothing are found
    against the distinct fact keys, which are combined before the shuffle. AQE splits a hot key of a left or inner join at
    run time, but neither side of a full one.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unknown join {how!r}")
    keys = [on] if isinstance(on, str) else list(on)
    spark = fact.sparkSession
    pieces = pieces or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(fact, keys, 1 / pieces)
    unknown = F.lit(False)
    for k in keys:
        unknown = unknown | F.col(f"`{k}`").isNull()
    times = F.lit(1)
    if heavy:
        known = F.create_map(*[F.lit(x) for pair in heavy for x in pair])
        times = F.coalesce(F.element_at(known, _hashed(fact, keys)), F.lit(1))
    plain = [c for c, t in fact.dtypes if "map<" not in t and "variant" not in t]
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in plain], F.lit(7))
    left = fact.withColumn("__salt", F.pmod(spread, F.when(unknown, F.lit(pieces)).otherwise(times).cast("bigint")))
    right = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), (times - 1).cast("bigint"))))
    out = join_kept_key(left, right, [*keys, "__salt"], "inner" if how in ("inner", "right") else "left").drop("__salt")
    if how in ("inner", "left"):
        return out
    seen = fact.select(*[F.col(f"`{k}`") for k in keys]).distinct()
    rest = join_kept_key(dim, seen, keys, "left_anti")
    return out.unionByName(rest, allowMissingColumns=True)


def parse_json_column(df: DataFrame, col: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """Parse a JSON text column to typed fields (permissive: bad text gives nulls)."""
    return df.select(*keep, F.from_json(F.col(col), schema).alias("__j")).select(*keep, "__j.*")
