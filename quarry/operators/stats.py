"""Two-sample t-test and chi-square test of independence as aggregates.

The heavy part is one distributed aggregate (conditional counts, means and
variances; or cell counts and their margins). What reaches Python is the
one-row summary, for the p-value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distributions import chi2_p_value, t_p_value
from ..session import keep
from .joins import join_small
from .quantiles import clean_value


def _safe_div(num: Column, den: Column) -> Column:
    return F.when(den != 0, num / den)


def _t_aggregates(value: Column, g: Column, a, b, tag: str = "") -> list[Column]:
    out = []
    for side, key in (("a", a), ("b", b)):
        v = F.when(g == key, value)
        out += [F.count(v).alias(f"n_{side}{tag}"), F.avg(v).alias(f"mean_{side}{tag}"), F.var_samp(v).alias(f"var_{side}{tag}")]
    return out


def _t_columns(a, b, equal_var: bool, tag: str = "") -> list[Column]:
    c = lambda name: F.col(f"{name}{tag}")
    na, nb = c("n_a").cast("double"), c("n_b").cast("double")
    va, vb = c("var_a"), c("var_b")
    diff = c("mean_a") - c("mean_b")
    if equal_var:
        dof = na + nb - 2
        pooled = _safe_div((na - 1) * va + (nb - 1) * vb, dof)
        se2 = pooled * (1 / na + 1 / nb)
    else:
        sa, sb = va / na, vb / nb
        se2 = sa + sb
        dof = _safe_div(se2 * se2, _safe_div(sa * sa, na - 1) + _safe_div(sb * sb, nb - 1))
    t = F.when(se2 > 0, diff / F.sqrt(se2))
    return [F.lit(a).alias("group_a"), F.lit(b).alias("group_b"),
            *[c(n).alias(n) for n in ("n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b")], t.alias("t"),
            F.when((na > 1) & (nb > 1), dof).alias("df")]


def t_summary(df: DataFrame, value: str, group: str, a, b, equal_var: bool = False) -> DataFrame:
    """``group_a, group_b, n_a, n_b, mean_a, mean_b, var_a, var_b, t, df`` (one row).

    Welch's test by default, Student's pooled-variance test with
    ``equal_var=True``. ``t`` is null when it is undefined (fewer than two
    values in a group, or zero variance in both).
    """
    g = F.col(group)
    return df.where(g.isin(a, b)).agg(*_t_aggregates(clean_value(value), g, a, b)).select(*_t_columns(a, b, equal_var))


def t_tests(df: DataFrame, values: Sequence[str], group: str, a, b, equal_var: bool = False) -> DataFrame:
    """``column`` and the columns of ``t_test``, one row per column, all from one pass over the input."""
    g = F.col(group)
    aggs = [e for i, v in enumerate(values) for e in _t_aggregates(clean_value(F.col(f"`{v}`")), g, a, b, str(i))]
    wide = df.where(g.isin(a, b)).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(v).alias("column"), *_t_columns(a, b, equal_var, str(i))) for i, v in enumerate(values)])
    return wide.select(F.inline(rows)).withColumn("p", t_p_value(F.col("t"), F.col("df")))


def t_test(df: DataFrame, value: str, group: str, a, b, equal_var: bool = False) -> DataFrame:
    """``t_summary`` plus the two-sided ``p``."""
    s = t_summary(df, value, group, a, b, equal_var)
    return s.withColumn("p", t_p_value(F.col("t"), F.col("df")))


def chi_square_summary(df: DataFrame, a: str, b: str, correction: bool = False) -> DataFrame:
    """``statistic, dof, n, n_a, n_b`` (one row) for independence of ``a`` and ``b``.

    Rows with a null in ``a`` or ``b`` are left out. Expected counts are
    ``row total * column total / n`` on the full grid of observed values:
    cells never observed contribute their expected count, which is summed as
    ``n - sum(expected of observed cells)`` instead of building the grid.
    ``correction`` applies Yates' continuity correction when ``dof == 1``. An
    empty table has a null statistic and dof 0.
    """
    ca, cb = F.col(f"`{a}`"), F.col(f"`{b}`")
    cells = df.where(ca.isNotNull() & cb.isNotNull()).groupBy(ca.alias("__a"), cb.alias("__b")).agg(F.count(F.lit(1)).alias("__o"))
    return _from_cells(keep(cells), correction)


def _from_cells(cells: DataFrame, correction: bool) -> DataFrame:
    """From kept cells ``__a, __b, __o`` (count) without nulls."""
    rows = cells.groupBy("__a").agg(F.sum("__o").alias("__rt"))
    cols = cells.groupBy("__b").agg(F.sum("__o").alias("__ct"))
    n = F.lit(cells.agg(F.sum("__o")).first()[0]).cast("double")
    j = join_small(join_small(cells, rows, ["__a"]), cols, ["__b"])
    e = F.col("__rt") * F.col("__ct") / n
    o = F.col("__o")
    yates = lambda obs: F.pow(F.greatest(F.abs(obs - e) - 0.5, F.lit(0.0)), 2) / e
    agg = j.agg(F.sum(F.pow(o - e, 2) / e).alias("__s"), F.sum(e).alias("__se"),
                F.sum(o).alias("n"), F.count(F.lit(1)).alias("__cells"),
                F.countDistinct("__a").alias("n_a"), F.countDistinct("__b").alias("n_b"),
                F.sum(yates(o)).alias("__sy"))
    dof = (F.greatest(F.col("n_a") - 1, F.lit(0)) * F.greatest(F.col("n_b") - 1, F.lit(0))).cast("long")
    total = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    gap = F.greatest(total - F.col("__se"), F.lit(0.0))  # expected counts of the cells never observed
    unseen = F.col("__cells") < F.col("n_a") * F.col("n_b")
    plain = F.col("__s") + F.when(unseen, gap).otherwise(F.lit(0.0))
    # A 2 x 2 table has one unseen cell at most or two on a diagonal, of equal expected count.
    blank = (F.col("n_a") * F.col("n_b") - F.col("__cells")).cast("double")
    corrected = F.col("__sy") + F.when(unseen, blank * F.pow(F.greatest(gap / blank - 0.5, F.lit(0.0)), 2) / (gap / blank)).otherwise(F.lit(0.0))
    stat = F.when(dof == 1, corrected).otherwise(plain) if correction else plain
    return agg.select(stat.alias("statistic"), dof.alias("dof"), total.alias("n"), "n_a", "n_b")


def chi_square(df: DataFrame, a: str, b: str, correction: bool = False) -> DataFrame:
    """``chi_square_summary`` plus the upper-tail ``p``."""
    return _with_p(chi_square_summary(df, a, b, correction))


def chi_square_of_cells(cells: DataFrame, a: str, b: str, count: str, correction: bool = False) -> DataFrame:
    """As ``chi_square``, from counted cells (one row per pair of values)."""
    kept = keep(cells.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.col(a).alias("__a"), F.col(b).alias("__b"), F.col(count).alias("__o")))
    return _with_p(_from_cells(kept, correction))


def _with_p(s: DataFrame) -> DataFrame:
    return s.withColumn("p", chi2_p_value(F.col("statistic"), F.col("dof").cast("double")))
