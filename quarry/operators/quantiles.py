"""Quantiles: exact (distributed), Spark's one-buffer ``percentile``, approximate.

Exact quantiles use linear interpolation between the values at 0-based ranks
``floor(h)`` and ``ceil(h)``, ``h = (n - 1) * p`` (the definition of Spark's
``percentile`` and DuckDB's ``quantile_cont``).

``method="exact"`` never gathers a group's values into one task:

1. **sketch** – one aggregate per group: ``count``, ``min``, ``max``, an approximate number of
   distinct values and ``percentile_approx`` at ``p - d`` and ``p + d``. The sketch is a mergeable
   summary of bounded size, so a hot group is combined map-side like a sum.
   Where no group has more than ``value_limit`` distinct values, counting values is cheaper than
   banding them: Spark's ``percentile`` holds one counter a value, which that limit bounds
   whatever the number of rows, and its answer is exact however far off the estimate is. Otherwise:
2. **band** – every value is compared with the band ``[lo, hi]`` of each
   quantile. Values below the band collapse to one counted marker; values
   inside are counted per distinct value; values above are dropped. A window
   over the ``(group, quantile)`` band turns counts into ranks and picks the
   two wanted ranks. A band holds about ``2 d n`` rows plus ties merged into one
   row each, independent of how the data is partitioned.
3. **refine** – if a band would be larger than ``band_limit`` rows (only for
   groups of billions of rows) it is first narrowed by cells of equal width
   and, in turn, of equal ratio: cell counts, a prefix sum over at most ``cells``
   rows per band, and the cells holding the wanted ranks become the new band.
   Repeated until small.
4. **check** – a wanted rank outside its band (the sketch missed) is detected
   from the counts, and that band restarts from ``[min, max]`` and is refined.
   The answer is therefore exact whatever the sketch returned.

Only one-row-per-group tables (the sketch and the per-band answers) are
materialized; their sizes are checked before any broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import keep, materialize
from .joins import join_small

QUARTILE_PROBS = (0.25, 0.5, 0.75)
QUARTILE_NAMES = ("q1", "median", "q3")

_V = "__v"
_N = "__n"
_D = "__distinct"

#: Distinct values up to which a group's values are counted in one buffer (about 100 bytes a value).
VALUE_LIMIT = 200_000


def clean_value(col: str | Column) -> Column:
    """Cast to double and turn NaN into null (NaN would rank above every value)."""
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    return F.nanvl(c, F.lit(None).cast("double"))


def _names(probs: Sequence[float], names: Sequence[str] | None) -> list[str]:
    if names is not None:
        if len(names) != len(probs):
            raise ValueError("one name per probability")
        return list(names)
    return [f"p{str(round(p * 100, 4)).rstrip('0').rstrip('.')}".replace(".", "_") for p in probs]


def quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] | None = None,
              method: str = "exact", accuracy: int = 10000, names: Sequence[str] | None = None,
              band_limit: int = 2_000_000, cells: int = 4096, value_limit: int | None = None) -> DataFrame:
    """One row per group: ``by..., n, <name per prob>``; ``n`` counts non-null values.

    ``method``: ``exact`` (distributed, default), ``percentile`` (Spark's
    exact aggregate: one buffer per group, for small groups), ``approx``
    (``percentile_approx`` with ``accuracy``). ``value_limit`` (default ``VALUE_LIMIT``): distinct
    values of a group up to which ``exact`` counts values instead of banding them; the answer is the same.
    """
    return quantile_table(df, col, probs, by, method, accuracy, names, band_limit, cells, value_limit=value_limit)[0]


def quantile_table(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] | None = None,
                   method: str = "exact", accuracy: int = 10000, names: Sequence[str] | None = None,
                   band_limit: int = 2_000_000, cells: int = 4096,
                   extra: Mapping[str, Column] | None = None, value_limit: int | None = None) -> tuple[DataFrame, int | None]:
    """``quantiles`` plus its number of rows when already known (no extra job),
    so a later join can decide on a broadcast without counting again.

    ``extra`` maps output names to aggregate expressions computed per group in
    the same pass over the input as the quantile sketch (no scan of their own).
    """
    extra = dict(extra or {})
    probs = [float(p) for p in probs]
    if not probs or any(not 0.0 <= p <= 1.0 for p in probs):
        raise ValueError("probabilities must lie in [0, 1]")
    by = list(by or [])
    out_names = _names(probs, names)
    v = clean_value(col)
    if method in ("approx", "percentile"):
        return _one_pass(df, v, probs, by, method, accuracy, out_names, extra), (1 if not by else None)
    if method != "exact":
        raise ValueError(f"unknown method {method!r}")
    if not by and not extra:
        # One result row: computed by two distributed jobs, returned as values.
        n, vals = exact_values(df, col, probs, accuracy, band_limit, cells, value_limit)
        schema = ", ".join(["n bigint"] + [f"`{nm}` double" for nm in out_names])
        return df.sparkSession.createDataFrame([(n, *vals)], schema), 1
    return _exact(df, v, probs, by, accuracy, out_names, band_limit, cells, extra, value_limit=value_limit)


def _one_pass(df: DataFrame, v: Column, probs: list[float], by: list[str], method: str, accuracy: int,
              out_names: list[str], extra: Mapping[str, Column]) -> DataFrame:
    agg = F.percentile_approx(v, probs, accuracy) if method == "approx" else F.percentile(v, probs)
    res = df.groupBy(*by).agg(F.count(v).alias("n"), agg.alias("__q"), *[e.alias(nm) for nm, e in extra.items()])
    return res.select(*by, "n", *[F.col("__q")[i].alias(nm) for i, nm in enumerate(out_names)], *extra)


def quartiles(df: DataFrame, col: str, by: Sequence[str] | None = None, method: str = "exact",
              accuracy: int = 10000, **kw) -> DataFrame:
    """``by..., n, q1, median, q3``."""
    return quantiles(df, col, QUARTILE_PROBS, by, method, accuracy, QUARTILE_NAMES, **kw)


def quartile_table(df: DataFrame, col: str, by: Sequence[str] | None = None, method: str = "exact",
                   accuracy: int = 10000, **kw) -> tuple[DataFrame, int | None]:
    return quantile_table(df, col, QUARTILE_PROBS, by, method, accuracy, QUARTILE_NAMES, **kw)


# ---------------------------------------------------------------------------
# exact, distributed

# The sketch's rank error is at most n/accuracy and a band reaches 3n/accuracy
# ranks either side, so it surely holds the wanted ranks (within one rank of
# p*n) once n*d >= 2, d = 3/accuracy. Smaller groups (fewer than
# 2*accuracy/3 values, and within band_limit) use their whole range as the
# band: a pass over so few values is cheaper than a missed band's restart.
_SMALL_RANKS = 2.0


def _small_group(n: int, d: float, band_limit: int) -> bool:
    return n * d < _SMALL_RANKS and n <= band_limit


def _band_index(probs: list[float], d: float):
    """Sketch probabilities and, per quantile, where each band end comes from:
    ``"min"``, ``"max"`` or an index into the sketch's result array."""
    approx_probs: list[float] = []
    lo_idx: list = []
    hi_idx: list = []
    for p in probs:
        for side, target in (("lo", p - d), ("hi", p + d)):
            if side == "lo" and target <= 0.0:
                lo_idx.append("min")
            elif side == "hi" and target >= 1.0:
                hi_idx.append("max")
            else:
                approx_probs.append(target)
                (lo_idx if side == "lo" else hi_idx).append(len(approx_probs) - 1)
    return approx_probs, lo_idx, hi_idx


def _band_exprs(probs: list[float], d: float):
    """Sketch probabilities and, per quantile, the band ends over sketch columns."""
    approx_probs, lo_idx, hi_idx = _band_index(probs, d)
    col = lambda i: F.col("__min") if i == "min" else F.col("__max") if i == "max" else F.col("__a")[i]
    return approx_probs, [col(i) for i in lo_idx], [col(i) for i in hi_idx]


def _log_scale(v: Column) -> Column:
    """An increasing map of the doubles to about [-1456, 1456] with equal room for each decade."""
    return F.when(v == 0, F.lit(0.0)).otherwise(F.signum(v) * (F.least(F.log(F.abs(v)), F.lit(710.0)) + 746))


def _emit_cells(bounds: list[tuple[Column, Column]], v: Column, cells: int, logarithmic: bool = False) -> Column:
    """Per value, the equal-width cell of each band it falls into (on a log scale if wanted).

    A concat of one-element or empty arrays (not a lambda filter), so the
    refinement pass stays inside whole-stage codegen.
    """
    empty = F.array().cast("array<struct<__pi:int,__cell:bigint>>")
    items = []
    scale = _log_scale if logarithmic else (lambda c: c)
    for i, (lo, hi) in enumerate(bounds):
        width = scale(hi) - scale(lo)
        cell = F.when(width > 0, F.least(F.floor((scale(v) - scale(lo)) / width * F.lit(cells)),
                                          F.lit(cells - 1))).otherwise(F.lit(0)).cast("long")
        one = F.array(F.struct(F.lit(i).alias("__pi"), cell.alias("__cell")))
        items.append(F.when((v >= lo) & (v <= hi), one).otherwise(empty))
    return F.concat(*items)


def _with_state(base: DataFrame, state: DataFrame, by: list[str], m: int,
                known_rows: int | None = None):
    """Attach band bounds to every value: literals when ungrouped (no join),
    else a size-checked join on the group keys."""
    if not by:
        row = state if isinstance(state, dict) else state.first()
        if row is None:
            return None, None
        los = [F.lit(row["__lo"][i]).cast("double") for i in range(m)]
        his = [F.lit(row["__hi"][i]).cast("double") for i in range(m)]
        nlit = F.lit(row[_N]).cast("long")
        return base.withColumn(_N, nlit), list(zip(los, his))
    joined = join_small(base, state.select(*by, _N, "__lo", "__hi"), by, known_rows=known_rows)
    return joined, [(F.col("__lo")[i], F.col("__hi")[i]) for i in range(m)]


def _final_pass(base: DataFrame, state, by: list[str], probs: list[float],
                known_rows: int | None = None) -> DataFrame:
    """Exact values at the wanted ranks, long format: by, __pi, __n, __v0, __v1.

    Each value becomes one row keyed for sorting: a value inside any band is
    its own key; a value between bands is keyed by the upper end of the band
    below it (or -inf below all bands) and marked as a gap; values above every
    band are dropped. Counting per ``(group, key, gap)`` merges the gaps into a
    handful of rows, so a window per group turns counts into ranks over only
    the band values (overlapping bands need no special case).
    """
    m = len(probs)
    joined, bounds = _with_state(base, state, by, 2 * m, known_rows)
    if joined is None:
        return None
    v = F.col(_V)
    in_band = None
    for lo, hi in bounds:
        c = (v >= lo) & (v <= hi)
        in_band = c if in_band is None else in_band | c
    gap_key = F.greatest(*[F.when(hi < v, hi) for _, hi in bounds], F.lit(float("-inf")))
    above = None
    for _, hi in bounds:
        c = v > hi
        above = c if above is None else above & c
    keyed = joined.where(~above).select(
        *by, _N, F.when(in_band, v).otherwise(gap_key).alias("__key"), (~in_band).alias("__gap"))
    cnt = keyed.groupBy(*by, _N, "__key", "__gap").agg(F.count(F.lit(1)).alias("__c"))
    w = (Window.partitionBy(*by).orderBy("__key", "__gap")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = cnt.withColumn("__cum", F.sum("__c").over(w))
    start = F.col("__cum") - F.col("__c")
    hits = []
    for i, p in enumerate(probs):
        h = (F.col(_N) - 1).cast("double") * F.lit(p)
        for j, k in enumerate((F.floor(h), F.ceil(h))):
            hit = ~F.col("__gap") & (start <= k) & (k < F.col("__cum"))
            hits.append(F.max(F.when(hit, F.col("__key"))).alias(f"__h{i}_{j}"))
    per_group = ranked.groupBy(*by, _N).agg(*hits)
    return per_group.select(*by, _N, F.inline(F.array(*[
        F.struct(F.lit(i).alias("__pi"), F.col(f"__h{i}_0").alias("__v0"),
                 F.col(f"__h{i}_1").alias("__v1")) for i in range(m)])))


def _refine(base: DataFrame, state: DataFrame, by: list[str], probs: list[float],
            band_limit: int, cells: int) -> DataFrame:
    """Narrow every band until it holds at most ``band_limit`` rows or one value.

    Rounds alternate between cells of equal width and cells of equal ratio: after
    one of the latter a band spans a third of a decade at most, and each of the
    former divides it by ``cells``, so doubles of any distribution need a handful.

    ``state``: by, __n, __min, __max and arrays __lo, __hi, __below with two
    bands per quantile, one per wanted rank (``floor(h)``, ``ceil(h)``). A
    single rank always lies in one cell, so each round shrinks its band to that
    cell's actual value range. A band whose rank is not inside it (the sketch
    missed) restarts from [min, max].
    """
    nb = 2 * len(probs)
    band_p = F.array(*[F.lit(p) for p in probs for _ in (0, 1)])
    turn = 0
    while True:
        turn += 1
        joined, bounds = _with_state(base, state, by, nb)
        if joined is None:
            return state
        cnt = (joined.select(*by, F.inline(_emit_cells(bounds, F.col(_V), cells, turn % 2 == 0)), _V)
               .groupBy(*by, "__pi", "__cell")
               .agg(F.count(F.lit(1)).alias("__c"), F.min(_V).alias("__cmin"),
                    F.max(_V).alias("__cmax")))
        keyed = state.select(*by, _N, "__min", "__max",
                             F.posexplode(F.arrays_zip("__lo", "__hi", "__below")).alias("__pi", "__b"))
        w = (Window.partitionBy(*by, "__pi").orderBy("__cell")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ranked = cnt.withColumn("__cum", F.sum("__c").over(w))
        on = by + ["__pi"]
        r = (keyed.join(ranked, on=[keyed[k].eqNullSafe(ranked[k]) for k in on], how="left")
             .select(*[keyed[k] for k in on], keyed[_N], keyed["__min"], keyed["__max"], keyed["__b"],
                     ranked["__c"], ranked["__cum"], ranked["__cmin"], ranked["__cmax"]))
        h = (F.col(_N) - 1).cast("double") * F.element_at(band_p, F.col("__pi") + 1)
        rank = F.when(F.col("__pi") % 2 == 0, F.floor(h)).otherwise(F.ceil(h))
        k = rank - F.col("__b.__below")
        start = F.col("__cum") - F.col("__c")
        hit = (start <= k) & (k < F.col("__cum"))
        per = r.groupBy(*by, "__pi", _N, "__min", "__max", "__b").agg(
            F.min(F.when(hit, F.col("__cmin"))).alias("__nlo"),
            F.max(F.when(hit, F.col("__cmax"))).alias("__nhi"),
            F.max(F.when(hit, start)).alias("__skip"),
            F.max(F.when(hit, F.col("__c"))).alias("__size"))
        ok = F.col("__nlo").isNotNull()
        per = per.select(
            *by, "__pi", _N, "__min", "__max",
            F.when(ok, F.col("__nlo")).otherwise(F.col("__min")).alias("__lo"),
            F.when(ok, F.col("__nhi")).otherwise(F.col("__max")).alias("__hi"),
            F.when(ok, F.col("__b.__below") + F.col("__skip")).otherwise(F.lit(0)).alias("__below"),
            F.when(ok, F.col("__size")).otherwise(F.col(_N)).alias("__size"),
            ok.alias("__ok"))
        per = materialize(per)
        # a band of one distinct value (ties) is as narrow as it gets
        open_size = F.when(F.col("__lo") < F.col("__hi"), F.col("__size")).otherwise(F.lit(0))
        stats = per.agg(F.max(open_size).alias("s"), F.count_if(~F.col("__ok")).alias("f")).first()
        state = materialize(per.groupBy(*by, _N, "__min", "__max").agg(
            F.array(*[F.max(F.when(F.col("__pi") == i, F.col("__lo"))) for i in range(nb)]).alias("__lo"),
            F.array(*[F.max(F.when(F.col("__pi") == i, F.col("__hi"))) for i in range(nb)]).alias("__hi"),
            F.array(*[F.max(F.when(F.col("__pi") == i, F.col("__below"))) for i in range(nb)]).alias("__below")))
        if stats["f"] == 0 and (stats["s"] or 0) <= band_limit:
            return state


def _interpolate(n: int, p: float, v0: float, v1: float) -> float:
    """Same arithmetic as the Column expression in ``_assemble``."""
    h = float(n - 1) * p
    lo, hi = math.floor(h), math.ceil(h)
    return v0 if lo == hi else (hi - h) * v0 + (h - lo) * v1


def exact_values(df: DataFrame, col: str | Column, probs: Sequence[float], accuracy: int = 10000,
                 band_limit: int = 2_000_000, cells: int = 4096,
                 value_limit: int | None = None) -> tuple[int, list[float | None]]:
    """Ungrouped exact quantiles as Python values: ``(n, [value per prob])``.

    Two jobs in the common case: the sketch (one row back) and the band pass
    (one row per probability back). Used where the bounds become literals.
    """
    probs = [float(p) for p in probs]
    v = clean_value(col)
    d = 3.0 / accuracy
    approx_probs, lo_idx, hi_idx = _band_index(probs, d)
    aggs = [F.count(v).alias(_N), F.min(v).alias("__min"), F.max(v).alias("__max"), F.approx_count_distinct(v).alias(_D)]
    if approx_probs:
        aggs.append(F.percentile_approx(v, approx_probs, accuracy).alias("__a"))
    sketch = df.agg(*aggs)
    row = sketch.first()
    n = row[_N]
    if not n:
        return 0, [None] * len(probs)
    if row[_D] <= (VALUE_LIMIT if value_limit is None else value_limit):
        return n, list(df.agg(F.percentile(v, probs).alias("q")).first()["q"])
    pick = lambda i: row["__min"] if i == "min" else row["__max"] if i == "max" else row["__a"][i]
    if _small_group(n, d, band_limit):
        # the sketch's band may be narrower than one rank: take the whole range
        state = {_N: n, "__lo": [row["__min"]] * (2 * len(probs)),
                 "__hi": [row["__max"]] * (2 * len(probs))}
    else:
        state = {_N: n, "__lo": [pick(i) for i in lo_idx for _ in (0, 1)],
                 "__hi": [pick(i) for i in hi_idx for _ in (0, 1)]}
    if n * (2 * d + 2.0 / accuracy) * len(probs) <= band_limit:
        base = df.select(v.alias(_V)).where(F.col(_V).isNotNull())
        got = {r["__pi"]: r for r in _final_pass(base, state, [], probs).collect()}
        if all(got.get(i) is not None and got[i]["__v0"] is not None and got[i]["__v1"] is not None
               for i in range(len(probs))):
            return n, [_interpolate(n, p, got[i]["__v0"], got[i]["__v1"]) for i, p in enumerate(probs)]
    # Large or missed bands: the general path (refinement, restart).
    known = df.sparkSession.createDataFrame([tuple(row)], sketch.schema)
    out, _ = _exact(df, v, probs, [], accuracy, [f"__q{i}" for i in range(len(probs))],
                    band_limit, cells, sketch=known, value_limit=value_limit)
    r = out.first()
    return n, [r[f"__q{i}"] for i in range(len(probs))]


def exact_values_wide(df: DataFrame, cols: Sequence[Column], probs: Sequence[float], extra: Sequence[Mapping[str, Column]] = (),
                      accuracy: int = 10000, band_limit: int = 2_000_000, cells: int = 4096) -> list[tuple[int, list, dict]]:
    """Ungrouped exact quantiles of several columns: ``(n, [value per prob], {extra})`` each.

    Three passes over the input whatever the number of columns: one wide sketch, one
    wide count of the values below each band, and one that emits only the
    values inside a band (about 0.2% of them per probability). Bounds are literals, so
    nothing is joined. Columns whose bands are missed or would be too large go
    through ``exact_values``.
    """
    probs = [float(p) for p in probs]
    values = [clean_value(c) for c in cols]
    extra = list(extra) or [{} for _ in values]
    d = 3.0 / accuracy
    approx_probs, lo_idx, hi_idx = _band_index(probs, d)
    aggs = []
    for i, v in enumerate(values):
        aggs += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
        if approx_probs:
            aggs.append(F.percentile_approx(v, approx_probs, accuracy).alias(f"a{i}"))
        aggs += [e.alias(f"x{i}_{name}") for name, e in extra[i].items()]
    if not aggs:
        return []
    row = df.agg(*aggs).first()
    found = {i: {name: row[f"x{i}_{name}"] for name in extra[i]} for i in range(len(values))}

    m = len(probs)
    bands: dict[int, tuple[float, float]] = {}  # band number (column, prob) to its ends
    for i in range(len(values)):
        n, low, high = row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]
        if not n or n * (2 * d + 2.0 / accuracy) * m > band_limit:
            continue
        pick = lambda k: low if k == "min" else high if k == "max" else row[f"a{i}"][k]  # noqa: B023, E731
        whole = _small_group(n, d, band_limit)
        for k in range(m):
            bands[i * m + k] = (low, high) if whole else (pick(lo_idx[k]), pick(hi_idx[k]))
    got: dict[int, tuple] = {}
    if bands:
        below = df.agg(*[F.count_if(values[b // m] < F.lit(lo)).alias(f"b{b}") for b, (lo, _) in bands.items()]).first()
        none = F.array().cast("array<struct<b:int,v:double>>")
        inside = [F.when(values[b // m].between(F.lit(lo), F.lit(hi)), F.array(F.struct(F.lit(b).alias("b"), values[b // m].alias("v")))).otherwise(none)
                  for b, (lo, hi) in bands.items()]
        counts = df.select(F.inline(F.concat(*inside, none))).groupBy("b", "v").agg(F.count(F.lit(1)).alias("c"))
        w = Window.partitionBy("b").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = counts.withColumn("end", F.sum("c").over(w))
        h = {b: (row[f"n{b // m}"] - 1) * probs[b % m] for b in bands}
        wanted = [F.create_map(*[F.lit(x) for b in bands for x in (b, f(h[b]) - below[f"b{b}"])]) for f in (math.floor, math.ceil)]
        hits = [F.max(F.when((F.col("end") - F.col("c") <= F.element_at(k, F.col("b"))) & (F.element_at(k, F.col("b")) < F.col("end")), F.col("v")))
                .alias(f"v{j}") for j, k in enumerate(wanted)]
        got = {r["b"]: (r["v0"], r["v1"]) for r in ranked.groupBy("b").agg(*hits).collect()}  # one row per band
    out = []
    for i, c in enumerate(cols):
        n = row[f"n{i}"]
        pairs = [got.get(i * m + k, (None, None)) for k in range(m)]
        if not n:
            answer = [None] * m
        elif any(a is None or b is None for a, b in pairs):
            answer = exact_values(df, c, probs, accuracy, band_limit, cells)[1]
        else:
            answer = [_interpolate(n, p, *pair) for p, pair in zip(probs, pairs)]
        out.append((n, answer, found[i]))
    return out


def _exact(df: DataFrame, v: Column, probs: list[float], by: list[str], accuracy: int,
           out_names: list[str], band_limit: int, cells: int,
           extra: Mapping[str, Column] | None = None, sketch: DataFrame | None = None,
           value_limit: int | None = None) -> tuple[DataFrame, int]:
    d = 3.0 / accuracy
    base = df.select(*by, v.alias(_V)).where(F.col(_V).isNotNull())
    approx_probs, lo_exprs, hi_exprs = _band_exprs(probs, d)
    aggs = [F.count(v).alias(_N), F.min(v).alias("__min"), F.max(v).alias("__max"), F.approx_count_distinct(v).alias(_D)]
    if approx_probs:
        aggs.append(F.percentile_approx(v, approx_probs, accuracy).alias("__a"))
    extra = dict(extra or {})
    aggs += [e.alias(nm) for nm, e in extra.items()]
    sk = keep(df.groupBy(*by).agg(*aggs)) if sketch is None else sketch
    # One action fills the sketch and returns its size and largest group.
    stats = sk.agg(F.count(F.lit(1)).alias("rows"), F.max(_N).alias("max_n"), F.max(_D).alias("most")).first()
    rows, max_n = stats["rows"], stats["max_n"] or 0
    if max_n and stats["most"] <= (VALUE_LIMIT if value_limit is None else value_limit):
        return _one_pass(df, v, probs, by, "percentile", accuracy, out_names, extra), rows
    # two bands per quantile (one per wanted rank), equal until refined
    # a small group's sketch band may be narrower than one rank: whole range
    small = (F.col(_N) * F.lit(d) < F.lit(_SMALL_RANKS)) & (F.col(_N) <= F.lit(band_limit))
    state = sk.where(F.col(_N) > 0).select(
        *by, _N, "__min", "__max",
        F.array(*[F.when(small, F.col("__min")).otherwise(e) for e in lo_exprs for _ in (0, 1)])
        .alias("__lo"),
        F.array(*[F.when(small, F.col("__max")).otherwise(e) for e in hi_exprs for _ in (0, 1)])
        .alias("__hi"),
        F.array(*[F.lit(0).cast("long") for _ in range(2 * len(probs))]).alias("__below"))
    if max_n == 0:
        return _assemble(sk, None, by, probs, out_names, list(extra), rows), rows

    groups = rows
    # the bands of all probabilities meet in one window: the limit is for their sum
    per_band = max(1, band_limit // len(probs))
    band_estimate = (2 * d + 2.0 / accuracy) * len(probs)
    if max_n * band_estimate > band_limit:
        state = _refine(base, state, by, probs, per_band, cells)

    res = keep(_final_pass(base, state, by, probs, rows))
    failed = res.where(F.col("__v0").isNull() | F.col("__v1").isNull())
    if res.agg(F.count_if(F.col("__v0").isNull() | F.col("__v1").isNull())).first()[0]:
        # The sketch missed for some bands: restart those groups from [min, max].
        bad_groups = keep(failed.select(*by).distinct()) if by else None
        restart = (state.join(bad_groups, on=[state[k].eqNullSafe(bad_groups[k]) for k in by],
                              how="left_semi") if by else state)
        nb = 2 * len(probs)
        restart = restart.select(*by, _N, "__min", "__max",
                                 F.array(*[F.col("__min") for _ in range(nb)]).alias("__lo"),
                                 F.array(*[F.col("__max") for _ in range(nb)]).alias("__hi"),
                                 F.array(*[F.lit(0).cast("long") for _ in range(nb)]).alias("__below"))
        restart = _refine(base, restart, by, probs, per_band, cells)
        sub_base = join_small(base, bad_groups, by, "left_semi") if by else base
        redo = keep(_final_pass(sub_base, restart, by, probs))
        good = (res.join(bad_groups, on=[res[k].eqNullSafe(bad_groups[k]) for k in by], how="left_anti")
                if by else res.limit(0))
        res = good.unionByName(redo)
    # sk and res (one row per group / per wanted rank) stay cached: the answer
    # is read from them by later actions.
    return _assemble(sk, res, by, probs, out_names, list(extra), rows), groups


def _assemble(sk: DataFrame, res: DataFrame | None, by: list[str], probs: list[float],
              out_names: list[str], extra_names: Sequence[str] = (),
              rows: int | None = None) -> DataFrame:
    empty = sk.where(F.col(_N) == 0).select(
        *by, F.col(_N).alias("n"), *[F.lit(None).cast("double").alias(nm) for nm in out_names],
        *extra_names)
    if res is None:
        return empty
    p = F.element_at(F.array(*[F.lit(x) for x in probs]), F.col("__pi") + 1)
    h = (F.col(_N) - 1).cast("double") * p
    lo = F.floor(h)
    hi = F.ceil(h)
    q = F.when(lo == hi, F.col("__v0")).otherwise(
        (hi - h) * F.col("__v0") + (h - lo) * F.col("__v1"))
    long = res.select(*by, "__pi", _N, q.alias("__q"))
    wide = long.groupBy(*by, _N).agg(
        *[F.max(F.when(F.col("__pi") == i, F.col("__q"))).alias(nm) for i, nm in enumerate(out_names)])
    wide = wide.withColumnRenamed(_N, "n")
    if extra_names:
        # the extra aggregates were computed with the sketch: one row per group
        side = sk.where(F.col(_N) > 0).select(*by, *extra_names)
        if by:
            wide = join_small(wide, side, by, known_rows=rows)
        else:
            r = side.first()
            wide = wide.select("*", *[F.lit(r[c] if r is not None else None)
                                      .cast(sk.schema[c].dataType).alias(c) for c in extra_names])
    return wide.unionByName(empty)
