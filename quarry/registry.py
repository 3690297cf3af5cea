"""Registered queries: the library's operators run on the generated tables.

Every query reads whole tables from ``sf_dir`` (nothing sampled, capped or
filtered to a subset) and returns a DataFrame whose column names match the
DuckDB oracle SQL in ``ORACLE``. Where a value has no SQL (fitted scores,
approximate ranks) the query returns invariants that SQL can state.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import rules
from .session import ensure_checkpoint_dir, keep
from .sources import files
from .operators.joins import join_small
from .operators import collect, eda, ingest, models, outliers, quantiles, report, sketches, stats, validate
from .plans import analysis, collect_job, iqr
from .streaming import stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# O: IQR outliers

_EV_BOUNDS = """
  SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
         quantile_cont(value, 0.75) AS q3
  FROM events WHERE value IS NOT NULL AND NOT isnan(value)
"""

_EV_BOUNDS_G = """
  SELECT event_type, count(value) AS n, quantile_cont(value, 0.25) AS q1,
         quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
  FROM events GROUP BY event_type
"""


@register("iqr_remove", f"""
WITH q AS ({_EV_BOUNDS}),
b AS (SELECT q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT e.* FROM events e, b WHERE e.value BETWEEN b.lower AND b.upper
""")
def q_iqr_remove(spark, sf):
    return outliers.remove_outliers(table(spark, sf, "events"), "value")


@register("iqr_plan", ORACLE["iqr_remove"])
def q_iqr_plan(spark, sf):
    return iqr.run(spark, f"{sf.rstrip('/')}/events.parquet", "value", out=_scratch(spark, "iqr-plan"))


@register("iqr_remove_grouped", f"""
WITH q AS ({_EV_BOUNDS_G}),
b AS (SELECT event_type, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT e.* FROM events e JOIN b ON e.event_type IS NOT DISTINCT FROM b.event_type
WHERE e.value BETWEEN b.lower AND b.upper
""")
def q_iqr_remove_grouped(spark, sf):
    return outliers.remove_outliers(table(spark, sf, "events"), "value", by=["event_type"])


@register("iqr_flag", f"""
WITH q AS ({_EV_BOUNDS_G}),
b AS (SELECT event_type, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT e.event_id, e.event_type, e.value,
       NOT (e.value BETWEEN b.lower AND b.upper) AS is_outlier
FROM events e LEFT JOIN b ON e.event_type IS NOT DISTINCT FROM b.event_type
""")
def q_iqr_flag(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type", "value")
    return outliers.flag_outliers(ev, "value", by=["event_type"])


@register("iqr_report", f"""
WITH q AS ({_EV_BOUNDS_G}),
b AS (SELECT event_type, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT e.event_type, count(*) AS n_rows,
       count_if(e.value BETWEEN b.lower AND b.upper)::BIGINT AS n_kept,
       count_if(NOT (e.value BETWEEN b.lower AND b.upper))::BIGINT AS n_outliers,
       count_if((e.value BETWEEN b.lower AND b.upper) IS NULL)::BIGINT AS n_null,
       max(b.lower) AS lower, max(b.upper) AS upper
FROM events e LEFT JOIN b ON e.event_type IS NOT DISTINCT FROM b.event_type
GROUP BY e.event_type
""")
def q_iqr_report(spark, sf):
    return outliers.outlier_report(table(spark, sf, "events"), "value", by=["event_type"])


@register("iqr_bounds", """
WITH q AS (
  SELECT l_returnflag, count(l_extendedprice) AS n, quantile_cont(l_extendedprice, 0.25) AS q1,
         quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3
  FROM lineitem GROUP BY l_returnflag)
SELECT l_returnflag, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(q3 - q1, 6) AS iqr, round(q1 - 3.0 * (q3 - q1), 6) AS lower,
       round(q3 + 3.0 * (q3 - q1), 6) AS upper
FROM q
""")
def q_iqr_bounds(spark, sf):
    b = outliers.iqr_bounds(table(spark, sf, "lineitem"), "l_extendedprice", k=3.0, by=["l_returnflag"])
    return b.select("l_returnflag", "n", *[_r(c) for c in ("q1", "median", "q3", "iqr", "lower", "upper")])


@register("quartiles_grouped", _EV_BOUNDS_G)
def q_quartiles_grouped(spark, sf):
    return quantiles.quartiles(table(spark, sf, "events"), "value", by=["event_type"])


@register("quartiles_exact", """
SELECT count(l_extendedprice) AS n, quantile_cont(l_extendedprice, 0.25) AS q1,
       quantile_cont(l_extendedprice, 0.5) AS median,
       quantile_cont(l_extendedprice, 0.75) AS q3
FROM lineitem
""")
def q_quartiles_exact(spark, sf):
    return quantiles.quartiles(table(spark, sf, "lineitem"), "l_extendedprice")


@register("quartiles_approx", """
SELECT event_type, count(value) AS n, true AS q1_ok, true AS median_ok, true AS q3_ok
FROM events GROUP BY event_type
""")
def q_quartiles_approx(spark, sf):
    """Whether each approximate quartile's rank is within n / 1000 + 1 of the wanted one."""
    ev = table(spark, sf, "events")
    return _ranks_near(ev, quantiles.quartiles(ev, "value", by=["event_type"], method="approx"), 0.001)


def _ranks_near(ev, q, share):
    v = quantiles.clean_value("value")
    j = join_small(ev.select("event_type", v.alias("v")), q, ["event_type"])
    below = {c: (F.count_if(F.col("v") < F.col(c)), F.count_if(F.col("v") <= F.col(c))) for c in quantiles.QUARTILE_NAMES}
    ranks = j.groupBy("event_type", "n").agg(*[e.alias(f"{c}_{k}") for c, pair in below.items() for k, e in enumerate(pair)])
    slack = F.col("n") * share + 1

    def near(c: str, p: float) -> Column:
        return (F.col(f"{c}_0") <= F.col("n") * p + slack) & (F.col(f"{c}_1") >= F.col("n") * p - slack)

    return ranks.select("event_type", "n", *[near(c, p).alias(f"{c}_ok") for c, p in zip(quantiles.QUARTILE_NAMES, quantiles.QUARTILE_PROBS)])


@register("quartiles_sketched", """
SELECT event_type, count(value) AS n, true AS q1_ok, true AS median_ok, true AS q3_ok, true AS read_once
FROM events GROUP BY event_type
""")
def q_quartiles_sketched(spark, sf):
    """Quartiles of a table that grew, from stored sketches: ranks within 1 % of the rows, and every file read once."""
    ev = table(spark, sf, "events").select("event_id", "event_type", "value")
    folder, store = _scratch(spark, "events-grown"), _scratch(spark, "events-sketches")
    late = F.pmod("event_id", F.lit(3)) == 0
    ev.where(~late).write.parquet(folder)
    first = sketches.update_sketches(spark, folder, store, "value", ["event_type"])
    ev.where(late).write.mode("append").parquet(folder)
    second = sketches.update_sketches(spark, folder, store, "value", ["event_type"])
    once = len(first) > 0 and len(second) > 0 and not set(first) & set(second) and sketches.update_sketches(spark, folder, store, "value", ["event_type"]) == []
    q = sketches.sketched_quantiles(sketches.stored_sketches(spark, store), quantiles.QUARTILE_PROBS, ["event_type"], quantiles.QUARTILE_NAMES)
    return _ranks_near(ev, q, 0.01).withColumn("read_once", F.lit(once))


# ---------------------------------------------------------------------------
# V: validation

def customer_rules():
    return [
        rules.required("c_name"),
        rules.matches("c_name", r"^Customer#[0-9]{9}$"),
        rules.typed(F.substring_index("c_name", "#", -1), "bigint", name="typed_bigint:c_name_number"),
        rules.in_range("c_acctbal", 0, 9000),
        rules.one_of("c_mktsegment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]),
        rules.check("nation_known", F.col("c_nationkey").between(0, 24)),
    ]


# The same rules in DuckDB SQL: (name, bad-predicate), in rule order.
_CUSTOMER_BAD_SQL = [
    ("required:c_name", "c_name IS NULL"),
    ("matches:c_name", "coalesce(NOT regexp_matches(c_name, '^Customer#[0-9]{9}$'), false)"),
    ("typed_bigint:c_name_number",
     "coalesce(regexp_extract(c_name, '[^#]*$') IS NOT NULL AND "
     "(TRY_CAST(regexp_extract(c_name, '[^#]*$') AS BIGINT) IS NULL OR "
     "NOT regexp_matches(regexp_extract(c_name, '[^#]*$'), '^\\s*[+-]?\\d+\\s*$')), false)"),
    ("in_range:c_acctbal", "coalesce(NOT (c_acctbal >= 0 AND c_acctbal <= 9000), false)"),
    ("one_of:c_mktsegment",
     "coalesce(NOT (c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')), false)"),
    ("nation_known", "coalesce(NOT (c_nationkey BETWEEN 0 AND 24), false)"),
]
_CUSTOMER_ERRORS_SQL = ("list_filter([" + ", ".join(
    f"CASE WHEN {p} THEN '{n}' END" for n, p in _CUSTOMER_BAD_SQL) + "], lambda x: x IS NOT NULL)")


@register("validate_errors", f"""
SELECT c_custkey, array_to_string({_CUSTOMER_ERRORS_SQL}, '|') AS errors FROM customer
""")
def q_validate_errors(spark, sf):
    out = validate.validate(table(spark, sf, "customer"), customer_rules())
    return out.select("c_custkey", F.array_join("errors", "|").alias("errors"))


@register("validate_valid", f"""
SELECT * FROM customer WHERE len({_CUSTOMER_ERRORS_SQL}) = 0
""")
def q_validate_valid(spark, sf):
    return validate.split_valid(table(spark, sf, "customer"), customer_rules())[0]


@register("validate_rejected", f"""
SELECT c_custkey, c_name, array_to_string({_CUSTOMER_ERRORS_SQL}, '|') AS errors
FROM customer WHERE len({_CUSTOMER_ERRORS_SQL}) > 0
""")
def q_validate_rejected(spark, sf):
    rej = validate.split_valid(table(spark, sf, "customer"), customer_rules())[1]
    return rej.select("c_custkey", "c_name", F.array_join("errors", "|").alias("errors"))


@register("error_summary", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT {i} AS rule_pos, '{n}' AS rule, count_if({p})::BIGINT AS n_failed, count(*) AS n_rows FROM customer"
    for i, (n, p) in enumerate(_CUSTOMER_BAD_SQL)) + ")")
def q_error_summary(spark, sf):
    return validate.error_summary(table(spark, sf, "customer"), customer_rules())


def order_rules():
    return [
        rules.in_range("o_totalprice", 1000, 450000),
        rules.one_of("o_orderstatus", ["O", "F", "P"]),
        rules.check("open_orders_recent",
                    (F.col("o_orderstatus") != "O") | (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))),
        rules.check("priority_coded", F.col("o_orderpriority").rlike(r"^[1-5]-")),
    ]


_ORDER_BAD_SQL = [
    ("in_range:o_totalprice", "coalesce(NOT (o_totalprice >= 1000 AND o_totalprice <= 450000), false)"),
    ("one_of:o_orderstatus", "coalesce(NOT (o_orderstatus IN ('O', 'F', 'P')), false)"),
    ("open_orders_recent",
     "coalesce(NOT (o_orderstatus <> 'O' OR o_orderdate >= TIMESTAMP '1997-01-01'), false)"),
    ("priority_coded", "coalesce(NOT regexp_matches(o_orderpriority, '^[1-5]-'), false)"),
]


@register("validate_cross", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT {i} AS rule_pos, '{n}' AS rule, count_if({p})::BIGINT AS n_failed, count(*) AS n_rows FROM orders"
    for i, (n, p) in enumerate(_ORDER_BAD_SQL)) + ")")
def q_validate_cross(spark, sf):
    return validate.error_summary(table(spark, sf, "orders"), order_rules())


# ---------------------------------------------------------------------------
# C: aggregation, comprehensions, generators

def _r(col: str, digits: int = 6):
    return F.round(F.col(col), digits).alias(col)


@register("group_stats", """
SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n,
       round(sum(l_extendedprice), 2) AS total, round(avg(l_extendedprice), 6) AS mean,
       min(l_extendedprice) AS min, max(l_extendedprice) AS max
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def q_group_stats(spark, sf):
    g = collect.group_stats(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"],
                            "l_extendedprice")
    return g.select("l_returnflag", "l_linestatus", "n", _r("total", 2), _r("mean"), "min", "max")


@register("collect_by_key", """
SELECT r.r_name, array_to_string(list_sort(list(n.n_name)), ',') AS nations
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name
""")
def q_collect_by_key(spark, sf):
    reg = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    nat = ingest.enrich(table(spark, sf, "nation"), reg, "n_regionkey", how="inner")
    out = collect.collect_by_key(nat, "r_name", "n_name")
    return out.select("r_name", F.array_join("items", ",").alias("nations"))


@register("collect_chunks", """
SELECT event_type, chunk, list(value ORDER BY value) AS items
FROM (SELECT event_type, value, CAST((row_number() OVER (PARTITION BY event_type ORDER BY value) - 1) // 1000 AS BIGINT) AS chunk
      FROM events WHERE value IS NOT NULL) GROUP BY ALL
""")
def q_collect_chunks(spark, sf):
    """All values of a key in order, in lists of at most 1,000."""
    return collect.collect_chunks(table(spark, sf, "events"), "event_type", "value", 1000)


@register("row_comprehension", """
SELECT p_partkey, upper(p_brand) AS brand, p_retailprice * 1.1::DOUBLE AS price_up
FROM part WHERE p_size > 25 AND p_type <> 'ECONOMY'
""")
def q_row_comprehension(spark, sf):
    p = table(spark, sf, "part")
    return collect.comprehend(p, (F.col("p_size") > 25) & (F.col("p_type") != "ECONOMY"),
                              p_partkey=F.col("p_partkey"), brand=F.upper("p_brand"),
                              price_up=F.col("p_retailprice") * 1.1)


@register("array_comprehension", """
SELECT vec_id, label,
       len(list_filter(embedding, lambda x: x > 0)) AS n_pos,
       round(list_reduce(list_transform(list_filter(embedding, lambda x: x > 0),
                                        lambda x: x::DOUBLE * x::DOUBLE),
                         lambda a, b: a + b, 0.0::DOUBLE), 9) AS pos_energy,
       round(list_max(embedding)::DOUBLE, 9) AS top
FROM embeddings
""")
def q_array_comprehension(spark, sf):
    e = table(spark, sf, "embeddings")
    pos = collect.array_comprehension("embedding", keep=lambda x: x > 0)
    sq = collect.array_comprehension(pos, f=lambda x: x.cast("double") * x.cast("double"))
    return e.select("vec_id", "label", F.size(pos).cast("long").alias("n_pos"),
                    F.round(collect.fold(sq, F.lit(0.0).cast("double"), lambda acc, x: acc + x), 9)
                    .alias("pos_energy"),
                    F.round(F.array_max("embedding").cast("double"), 9).alias("top"))


@register("row_generator", """
WITH w AS (SELECT role, unnest(regexp_split_to_array(text, '[ \\t\\n\\r]+')) AS word FROM conversations)
SELECT role, word, count(*) AS n FROM w WHERE word <> '' GROUP BY role, word
""")
def q_row_generator(spark, sf):
    c = table(spark, sf, "conversations")
    words = collect.generate_rows(c, collect.tokens("text"), ["role"], name="word")
    return words.groupBy("role", "word").agg(F.count(F.lit(1)).alias("n"))


def _event_batch(pdf):
    k = pdf["props"].str.extract(r'"k":\s*(-?\d+)', expand=False)
    out = pd.DataFrame({
        "event_id": pdf["event_id"],
        "event_type": pdf["event_type"].str.upper(),
        "k": pd.to_numeric(k, errors="coerce").astype("Int64"),
        "big": pdf["value"] > 100.0,
    })
    return out[pdf["value"] > 0]


@register("batch_generator", """
SELECT event_id, upper(event_type) AS event_type,
       TRY_CAST(regexp_extract(props, '"k":\\s*(-?\\d+)', 1) AS BIGINT) AS k,
       value > 100.0 AS big
FROM events WHERE value > 0
""")
def q_batch_generator(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type", "value", "props")
    return collect.map_batches(ev, _event_batch, "event_id long, event_type string, k long, big boolean")


# ---------------------------------------------------------------------------
# E: EDA tables

_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("profile_numeric", " UNION ALL ".join(f"""
SELECT '{c}' AS column, count({c}) AS n, count(*) - count({c}) AS n_null,
       round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, min({c}) AS min,
       round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median,
       round(quantile_cont({c}, 0.75), 6) AS q3, max({c}) AS max FROM lineitem""" for c in _LI_NUM))
def q_profile_numeric(spark, sf):
    p = eda.profile_numeric(table(spark, sf, "lineitem"), _LI_NUM)
    return p.select("column", "n", "n_null", _r("mean"), _r("stddev"), "min", _r("q1"),
                    _r("median"), _r("q3"), "max")


_CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@register("profile_missing", " UNION ALL ".join(f"""
SELECT '{c}' AS column, count(*) AS n_rows, count(*) - count({c}) AS n_null,
       (count(*) - count({c})) / count(*) AS null_share FROM customer""" for c in _CUST_COLS))
def q_profile_missing(spark, sf):
    return eda.profile_missing(table(spark, sf, "customer"), _CUST_COLS)


@register("value_counts", """
SELECT event_type, count(*) AS count, count(*) / (SELECT count(*) FROM events) AS share
FROM events GROUP BY event_type
""")
def q_value_counts(spark, sf):
    return eda.value_counts(table(spark, sf, "events"), "event_type")


@register("value_counts_top", """
SELECT user_id, count(*) AS count, count(*) / (SELECT count(*) FROM events) AS share
FROM events GROUP BY user_id ORDER BY count DESC, user_id LIMIT 10
""")
def q_value_counts_top(spark, sf):
    return eda.value_counts(table(spark, sf, "events"), "user_id", n=10)


@register("histogram", """
WITH b AS (
  SELECT least(floor((l_quantity - 1.0::DOUBLE) / 4.9::DOUBLE), 9)::BIGINT AS bin, count(*) AS c
  FROM lineitem WHERE l_quantity BETWEEN 1.0::DOUBLE AND 50.0::DOUBLE GROUP BY 1)
SELECT g.bin, 1.0::DOUBLE + g.bin * 4.9::DOUBLE AS lower,
       1.0::DOUBLE + (g.bin + 1) * 4.9::DOUBLE AS upper,
       coalesce(b.c, 0) AS count
FROM range(10) g(bin) LEFT JOIN b ON g.bin = b.bin
""")
def q_histogram(spark, sf):
    return eda.histogram(table(spark, sf, "lineitem"), "l_quantity", 1.0, 50.0, 10)


@register("box_stats", f"""
WITH q AS ({_EV_BOUNDS_G}),
b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT e.event_type, b.n, round(b.q1, 6) AS q1, round(b.median, 6) AS median, round(b.q3, 6) AS q3,
       min(CASE WHEN e.value BETWEEN b.lower AND b.upper THEN e.value END) AS lower_whisker,
       max(CASE WHEN e.value BETWEEN b.lower AND b.upper THEN e.value END) AS upper_whisker,
       count_if(NOT (e.value BETWEEN b.lower AND b.upper))::BIGINT AS n_outliers
FROM events e JOIN b ON e.event_type = b.event_type
GROUP BY e.event_type, b.n, b.q1, b.median, b.q3
""")
def q_box_stats(spark, sf):
    b = eda.box_stats(table(spark, sf, "events"), "value", by=["event_type"])
    return b.select("event_type", "n", _r("q1"), _r("median"), _r("q3"), "lower_whisker",
                    "upper_whisker", "n_outliers")


@register("correlation_pairs", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for i, a in enumerate(_LI_NUM) for b in _LI_NUM[i + 1:]))
def q_correlation_pairs(spark, sf):
    c = eda.correlation_pairs(table(spark, sf, "lineitem"), _LI_NUM)
    return c.select("col_a", "col_b", _r("corr"))


@register("correlation_gram", ORACLE["correlation_pairs"])
def q_correlation_gram(spark, sf):
    """The same correlations by products of matrices, as wide tables take them."""
    c = eda.gram_correlations(table(spark, sf, "lineitem"), _LI_NUM)
    return c.select("col_a", "col_b", _r("corr"))


@register("crosstab", """
WITH c AS (SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY ALL)
SELECT l_returnflag, l_linestatus, count,
       round(count / sum(count) OVER (PARTITION BY l_returnflag), 9) AS row_share,
       round(count / sum(count) OVER (PARTITION BY l_linestatus), 9) AS col_share
FROM c
""")
def q_crosstab(spark, sf):
    x = eda.crosstab_long(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")
    return x.select("l_returnflag", "l_linestatus", "count", _r("row_share", 9), _r("col_share", 9))


@register("crosstab_complete", """
WITH c AS (SELECT n_regionkey, n_name, count(*) AS o FROM nation GROUP BY ALL),
g AS (SELECT DISTINCT a.n_regionkey, b.n_name FROM nation a, nation b),
f AS (SELECT g.n_regionkey, g.n_name, coalesce(c.o, 0) AS count FROM g LEFT JOIN c USING (n_regionkey, n_name))
SELECT n_regionkey, n_name, count, round(count / sum(count) OVER (PARTITION BY n_regionkey), 9) AS row_share,
       round(count / sum(count) OVER (PARTITION BY n_name), 9) AS col_share
FROM f
""")
def q_crosstab_complete(spark, sf):
    x = eda.crosstab_long(table(spark, sf, "nation"), "n_regionkey", "n_name", complete=True)
    return x.select("n_regionkey", "n_name", "count", _r("row_share", 9), _r("col_share", 9))


@register("rate_by", """
SELECT d.lang, count(l.quality) AS n, sum(l.quality)::BIGINT AS n_flag,
       round(avg(l.quality), 9) AS rate
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang
""")
def q_rate_by(spark, sf):
    j = table(spark, sf, "documents").select("doc_id", "lang").join(
        table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    r = eda.rate_by(j, ["lang"], "quality")
    return r.select("lang", "n", "n_flag", _r("rate", 9))


# ---------------------------------------------------------------------------
# T: statistical tests

_T_GROUPS_SQL = """
  SELECT count(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_a,
         count(o_totalprice) FILTER (WHERE o_orderpriority = '5-LOW') AS n_b,
         avg(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT') AS mean_a,
         avg(o_totalprice) FILTER (WHERE o_orderpriority = '5-LOW') AS mean_b,
         var_samp(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT') AS var_a,
         var_samp(o_totalprice) FILTER (WHERE o_orderpriority = '5-LOW') AS var_b
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
"""


def _t_out(s):
    return s.select("group_a", "group_b", "n_a", "n_b", _r("mean_a"), _r("mean_b"),
                    _r("t", 9), _r("df", 6))


@register("t_test_welch", f"""
WITH s AS ({_T_GROUPS_SQL})
SELECT '1-URGENT' AS group_a, '5-LOW' AS group_b, n_a, n_b, round(mean_a, 6) AS mean_a,
       round(mean_b, 6) AS mean_b,
       round((mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b), 9) AS t,
       round(pow(var_a / n_a + var_b / n_b, 2) /
             (pow(var_a / n_a, 2) / (n_a - 1) + pow(var_b / n_b, 2) / (n_b - 1)), 6) AS df
FROM s
""")
def q_t_test_welch(spark, sf):
    return _t_out(stats.t_summary(table(spark, sf, "orders"), "o_totalprice", "o_orderpriority",
                                  "1-URGENT", "5-LOW"))


@register("t_test_student", f"""
WITH s AS ({_T_GROUPS_SQL})
SELECT '1-URGENT' AS group_a, '5-LOW' AS group_b, n_a, n_b, round(mean_a, 6) AS mean_a,
       round(mean_b, 6) AS mean_b,
       round((mean_a - mean_b) / sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / (n_a + n_b - 2)
             * (1.0 / n_a + 1.0 / n_b)), 9) AS t,
       round((n_a + n_b - 2)::DOUBLE, 6) AS df
FROM s
""")
def q_t_test_student(spark, sf):
    return _t_out(stats.t_summary(table(spark, sf, "orders"), "o_totalprice", "o_orderpriority",
                                  "1-URGENT", "5-LOW", equal_var=True))


@register("t_test_p", f"""
WITH s AS ({_T_GROUPS_SQL}),
t AS (SELECT abs((mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b)) AS t,
             pow(var_a / n_a + var_b / n_b, 2) /
             (pow(var_a / n_a, 2) / (n_a - 1) + pow(var_b / n_b, 2) / (n_b - 1)) AS df FROM s),
f AS (SELECT i, t, exp(lgamma((df + 1) / 2) - lgamma(df / 2) - 0.5 * ln(df * pi())
                       - (df + 1) / 2 * ln(1 + pow(t * i / 2000, 2) / df)) AS y
      FROM t, range(2001) r(i))
SELECT '1-URGENT' AS group_a, '5-LOW' AS group_b,
       round(1 - 2 * max(t) / 2000 / 3 * sum(y * CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END), 7) AS p
FROM f
""")
def q_t_test_p(spark, sf):
    t = stats.t_test(table(spark, sf, "orders"), "o_totalprice", "o_orderpriority", "1-URGENT", "5-LOW")
    return t.select("group_a", "group_b", _r("p", 7))


@register("chi_square", """
WITH c AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS o FROM lineitem GROUP BY ALL),
r AS (SELECT a, sum(o) AS rt FROM c GROUP BY a),
k AS (SELECT b, sum(o) AS ct FROM c GROUP BY b),
t AS (SELECT sum(o) AS n FROM c),
e AS (SELECT c.o, r.rt * k.ct / t.n AS e FROM c JOIN r USING (a) JOIN k USING (b), t)
SELECT round(sum(pow(o - e, 2) / e), 9) AS statistic,
       ((SELECT count(*) FROM r) - 1) * ((SELECT count(*) FROM k) - 1) AS dof,
       sum(o)::BIGINT AS n
FROM e
""")
def q_chi_square(spark, sf):
    s = stats.chi_square_summary(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")
    return s.select(_r("statistic", 9), "dof", "n")


_CHI_SQL = """
WITH c AS (SELECT {a} AS a, {b} AS b, count(*) AS o FROM lineitem GROUP BY ALL),
r AS (SELECT a, sum(o) AS rt FROM c GROUP BY a),
k AS (SELECT b, sum(o) AS ct FROM c GROUP BY b),
t AS (SELECT sum(o) AS n FROM c),
e AS (SELECT c.o, r.rt * k.ct / t.n AS e FROM c JOIN r USING (a) JOIN k USING (b), t)
"""


# two degrees of freedom: the upper tail is exp(-x / 2)
@register("chi_square_p", _CHI_SQL.format(a="l_returnflag", b="l_linestatus") + """
SELECT round(sum(pow(o - e, 2) / e), 9) AS statistic,
       ((SELECT count(*) FROM r) - 1) * ((SELECT count(*) FROM k) - 1) AS dof,
       round(exp(-sum(pow(o - e, 2) / e) / 2), 9) AS p
FROM e
""")
def q_chi_square_p(spark, sf):
    c = stats.chi_square(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")
    return c.select(_r("statistic", 9), "dof", _r("p", 9))


@register("chi_square_yates", _CHI_SQL.format(a="l_linestatus", b="l_quantity > 25") + """
SELECT round(sum(pow(greatest(abs(o - e) - 0.5, 0), 2) / e), 9) AS statistic, sum(o)::BIGINT AS n FROM e
""")
def q_chi_square_yates(spark, sf):
    li = table(spark, sf, "lineitem").select("l_linestatus", (F.col("l_quantity") > 25).alias("bulk"))
    return stats.chi_square_summary(li, "l_linestatus", "bulk", correction=True).select(_r("statistic", 9), "n")


# ---------------------------------------------------------------------------
# M: models on documents + labels

def document_features(spark, sf):
    """Per labelled document: numeric text features, two categories, label."""
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    n = F.greatest(F.length("text"), F.lit(1))
    # join first: the regular expressions then run on labelled documents only;
    # they remove runs, not single characters: one match a run
    return d.join(lab, "doc_id").select(
        "doc_id", "label", "lang", "source",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(collect.tokens("text")).cast("double").alias("n_words"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        (F.length(F.regexp_replace("text", "[^A-Z]+", "")) / n).alias("upper_share"),
        (F.length(F.regexp_replace("text", "[^0-9]+", "")) / n).alias("digit_share"),
        (F.length(F.regexp_replace("text", "[^!?.]+", "")) / n).alias("punct_share"))


_NUMERIC_FEATURES = ["n_chars", "n_words", "n_lines", "upper_share", "digit_share", "punct_share"]


def _parts(data):
    """(train, test) by the first digit of the id's md5, which SQL has too."""
    held = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1).isin("0", "1", "2")
    return data.where(~held), data.where(held)


_FEATURES_SQL = """
  SELECT d.doc_id, l.quality::DOUBLE AS label, d.lang, d.source, d.n_chars::DOUBLE AS n_chars,
         length(regexp_replace(d.text, '[^A-Z]', '', 'g')) / greatest(length(d.text), 1) AS upper_share,
         substr(md5(d.doc_id::VARCHAR), 1, 1) IN ('0', '1', '2') AS held
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


@register("model_comparison", f"""
WITH d AS ({_FEATURES_SQL}), t AS (SELECT count(*) AS n, count_if(label = 1) AS n_pos FROM d WHERE held)
SELECT rank, true AS known_model, true AS beats_chance, true AS adds_up, n, n_pos::BIGINT AS n_pos,
       round(greatest(n_pos, n - n_pos) / n, 9) AS majority_accuracy
FROM t, (SELECT unnest(range(1, 4))::INTEGER AS rank)
""")
def q_model_comparison(spark, sf):
    """Fitted scores have no SQL: counts, and for each ranked model whether its figures hold together and beat chance.

    The values of the figures are checked by ``model_comparison_values``, the preprocessing by ``fitted_features``.
    """
    train, test = _parts(keep(document_features(spark, sf)))  # every later pass reads the kept numbers, not the texts
    stages = models.fit_features(train, _NUMERIC_FEATURES, ["lang", "source"])
    got = models.compare_models(train, test, stages, order_key="doc_id", partitions=8)
    c = F.col
    return got.select("rank", c("model").isin(list(models.default_estimators())).alias("known_model"),
                      (c("auc") > 0.5).alias("beats_chance"),
                      ((c("tp") + c("fp") + c("fn") + c("tn") == c("n")) & (c("tp") + c("fn") == c("n_pos"))).alias("adds_up"),
                      "n", "n_pos", _r("majority_accuracy", 9))


@register("model_comparison_values", f"""
WITH d AS ({_FEATURES_SQL}),
m AS (SELECT quantile_cont(n_chars, 0.5) FILTER (WHERE label = 1) AS c1, quantile_cont(n_chars, 0.5) FILTER (WHERE label = 0) AS c0,
             quantile_cont(upper_share, 0.5) FILTER (WHERE label = 1) AS u1, quantile_cont(upper_share, 0.5) FILTER (WHERE label = 0) AS u0
      FROM d WHERE NOT held),
r AS (SELECT source, (count_if(label = 1) + 1) / (count(*) + 2) AS rate FROM d WHERE NOT held AND source IS NOT NULL GROUP BY source),
z AS (SELECT 'length' AS model, label, (n_chars - (c1 + c0) / 2) * sign(c1 - c0) / coalesce(nullif(abs(c1 - c0), 0), 1) AS z FROM d, m WHERE held
      UNION ALL
      SELECT 'capitals', label, (upper_share - (u1 + u0) / 2) * sign(u1 - u0) / coalesce(nullif(abs(u1 - u0), 0), 1) FROM d, m WHERE held),
s AS (SELECT model, label, 0.5 + 0.5 * coalesce(z, 0) / (1 + abs(coalesce(z, 0))) AS score FROM z
      UNION ALL SELECT 'source', label, coalesce(rate, 0.5) FROM d LEFT JOIN r USING (source) WHERE held),
p AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction,
             rank() OVER (PARTITION BY model ORDER BY score) + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS rk FROM s),
c AS (SELECT model, count(*) AS n, count_if(label = 1) AS n_pos, count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 1) AS fp,
             count_if(label = 1 AND prediction = 0) AS fn, count_if(label = 0 AND prediction = 0) AS tn,
             (sum(rk) FILTER (WHERE label = 1) - count_if(label = 1) * (count_if(label = 1) + 1) / 2.0)
             / (count_if(label = 1) * count_if(label = 0)) AS auc FROM p GROUP BY model)
SELECT row_number() OVER (ORDER BY auc DESC, model)::INTEGER AS rank, model, n, n_pos::BIGINT AS n_pos, tp::BIGINT AS tp, fp::BIGINT AS fp,
       fn::BIGINT AS fn, tn::BIGINT AS tn, round((tp + tn) / n, 9) AS accuracy, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END, 9) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, 9) AS recall, round(CASE WHEN tp > 0 THEN 2.0 * tp / (2 * tp + fp + fn) END, 9) AS f1,
       round(auc, 9) AS auc
FROM c
""")
def q_model_comparison_values(spark, sf):
    """Three fitted rules through the same comparison: every figure has SQL, and a wrong score would show in it."""
    train, test = _parts(document_features(spark, sf).select("doc_id", "label", "source", "n_chars", "upper_share"))
    rules = {"length": models.MedianRule("n_chars"), "capitals": models.MedianRule("upper_share"), "source": models.CategoryRate("source")}
    got = models.compare_models(train, test, None, rules, order_key="doc_id", partitions=8)
    return got.select("rank", "model", "n", "n_pos", "tp", "fp", "fn", "tn",
                      *[_r(c, 9) for c in ("accuracy", "precision", "recall", "f1", "auc")])


@register("fitted_features", f"""
WITH d AS ({_FEATURES_SQL}),
m AS (SELECT quantile_cont(n_chars, 0.5) AS c, quantile_cont(upper_share, 0.5) AS u FROM d WHERE NOT held),
v AS (SELECT stddev_samp(coalesce(n_chars, c)) AS cs, stddev_samp(coalesce(upper_share, u)) AS us FROM d, m WHERE NOT held),
l AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS i FROM d WHERE NOT held AND lang IS NOT NULL GROUP BY lang),
s AS (SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS i FROM d WHERE NOT held AND source IS NOT NULL GROUP BY source)
SELECT doc_id, round(coalesce(n_chars, c) / cs, 9) AS n_chars, round(coalesce(upper_share, u) / us, 9) AS upper_share,
       coalesce(l.i, (SELECT count(*) FROM l))::DOUBLE AS lang, coalesce(s.i, (SELECT count(*) FROM s))::DOUBLE AS source
FROM d LEFT JOIN l USING (lang) LEFT JOIN s USING (source), m, v
""")
def q_fitted_features(spark, sf):
    """Preprocessing fitted on the training part, as columns of all labelled documents."""
    data = keep(document_features(spark, sf).select("doc_id", "lang", "source", "n_chars", "upper_share"))
    fitted = models.fit_features(_parts(data)[0], ["n_chars", "upper_share"], ["lang", "source"])
    return fitted.columns(data).select("doc_id", _r("n_chars__num", 9).alias("n_chars"), _r("upper_share__num", 9).alias("upper_share"),
                                       F.col("lang__idx").alias("lang"), F.col("source__idx").alias("source"))


@register("category_dictionary", """
SELECT value, count, row_number() OVER (ORDER BY count DESC, value) - 1 AS index
FROM (SELECT l_orderkey::VARCHAR AS value, count(*) AS count FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1)
""")
def q_category_dictionary(spark, sf):
    """Frequency ranks of a column of very many categories."""
    return models.category_dictionary(table(spark, sf, "lineitem"), "l_orderkey")


def _scored_labels(spark, sf):
    """A fixed prediction table from the data: score = share of upper-case letters."""
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    d = table(spark, sf, "documents").join(lab, "doc_id").select(
        "doc_id", "label", (F.length(F.regexp_replace("text", "[^A-Z]", "")) /
                            F.greatest(F.length("text"), F.lit(1))).alias("score"))
    return d.withColumn(
        "prediction", F.when(F.col("score") > 0.02, 1.0).otherwise(0.0))


_SCORED_SQL = """
  SELECT d.doc_id, l.quality::DOUBLE AS label,
         length(regexp_replace(d.text, '[^A-Z]', '', 'g')) / greatest(length(d.text), 1) AS score,
         CASE WHEN length(regexp_replace(d.text, '[^A-Z]', '', 'g')) / greatest(length(d.text), 1) > 0.02
              THEN 1.0 ELSE 0.0 END AS prediction
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


@register("binary_metrics", f"""
WITH s AS ({_SCORED_SQL}),
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM s),
a AS (SELECT (sum(rk) FILTER (WHERE label = 1) - count_if(label = 1) * (count_if(label = 1) + 1) / 2.0)
             / (count_if(label = 1) * count_if(label = 0)) AS auc FROM r),
m AS (SELECT count(*) AS n, count_if(label = 1)::BIGINT AS n_pos,
             count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 1) AS fp,
             count_if(label = 1 AND prediction = 0) AS fn, count_if(label = prediction) AS correct FROM s)
SELECT n, n_pos, round(correct / n, 9) AS accuracy,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END, 9) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, 9) AS recall,
       round(CASE WHEN tp > 0 THEN 2.0 * tp / (2 * tp + fp + fn) END, 9) AS f1,
       round(auc, 9) AS auc, round(greatest(n_pos, n - n_pos) / n, 9) AS majority_accuracy
FROM m, a
""")
def q_binary_metrics(spark, sf):
    m = models.binary_metrics(_scored_labels(spark, sf), score="score")
    return m.select("n", "n_pos", *[_r(c, 9) for c in
                                    ("accuracy", "precision", "recall", "f1", "auc", "majority_accuracy")])


@register("confusion", f"""
WITH s AS ({_SCORED_SQL})
SELECT label, prediction::DOUBLE AS prediction, count(*) AS count FROM s GROUP BY ALL
""")
def q_confusion(spark, sf):
    return models.confusion(_scored_labels(spark, sf))


@register("split_sizes", """
SELECT count(*) AS n, true AS disjoint, true AS complete, true AS share_ok
FROM documents JOIN labels USING (doc_id)
""")
def q_split_sizes(spark, sf):
    """Invariants of a hash split: parts disjoint, union complete, test share near the wanted one."""
    data = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select("doc_id")
    train, test = models.split(data, "doc_id", 0.2, salt=7)
    parts = train.select("doc_id", F.lit(0).alias("t")).unionByName(test.select("doc_id", F.lit(1).alias("t")))
    per = data.groupBy("doc_id").agg(F.count("*").alias("want")).join(
        parts.groupBy("doc_id").agg(F.count("*").alias("got"), F.sum("t").alias("t")), "doc_id", "full")
    n = F.sum("want")
    return per.agg(n.alias("n"), F.bool_and((F.col("t") == 0) | (F.col("t") == F.col("got"))).alias("disjoint"),
                   F.bool_and(F.col("want").eqNullSafe(F.col("got"))).alias("complete"),
                   F.abs(F.sum("t") / n - 0.2).__lt__(0.1).alias("share_ok"))


# ---------------------------------------------------------------------------
# J: payload shaping and enrichment

@register("json_extract", """
SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def q_json_extract(spark, sf):
    return ingest.parse_json_column(table(spark, sf, "events"), "props", "k int", keep=["event_id"])


@register("enrich_join", """
SELECT c.c_custkey, c.c_name, n.n_name, r.r_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def q_enrich_join(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    nat = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name",
                                            "n_regionkey")
    reg = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    out = ingest.enrich(ingest.enrich(cust, nat, "c_nationkey"), reg, "n_regionkey")
    return out.select("c_custkey", "c_name", "n_name", "r_name")


# Customers in debt have no known nation and two market segments are dealt to one nation; nation keys are shifted,
# so that some match no customer and some customers no nation.
_SKEWED_SQL = """
  SELECT c.c_custkey, CASE WHEN c.c_acctbal < 0 THEN NULL WHEN c.c_mktsegment < 'F' THEN 7 ELSE c.c_nationkey END AS nation
  FROM customer c
"""
_SHIFTED_SQL = "SELECT n_nationkey + 5 AS nation, n_name FROM nation"


def _skewed_customers(spark, sf):
    c = table(spark, sf, "customer")
    nation = F.when(F.col("c_acctbal") < 0, F.lit(None)).when(F.col("c_mktsegment") < "F", 7).otherwise(F.col("c_nationkey"))
    return c.select("c_custkey", nation.cast("int").alias("nation"))


def _shifted_nations(spark, sf):
    return table(spark, sf, "nation").select((F.col("n_nationkey") + 5).cast("int").alias("nation"), "n_name")


@register("enrich_full", f"""
SELECT coalesce(c.nation, n.nation)::INTEGER AS nation, c.c_custkey, n.n_name
FROM ({_SKEWED_SQL}) c FULL JOIN ({_SHIFTED_SQL}) n ON c.nation = n.nation
""")
def q_enrich_full(spark, sf):
    """Full join of whole tables: rows without a match on either side, a hot key, and unknown keys."""
    return ingest.enrich(_skewed_customers(spark, sf), _shifted_nations(spark, sf), "nation", how="full").select("nation", "c_custkey", "n_name")


@register("enrich_salted", ORACLE["enrich_full"])
def q_enrich_salted(spark, sf):
    """The same rows with the hot and the unknown key dealt over tasks."""
    got = ingest.enrich_salted(_skewed_customers(spark, sf), _shifted_nations(spark, sf), "nation", how="full")
    return got.select("nation", "c_custkey", "n_name")


@register("flatten_parallel", """
SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS pos,
       unnest(embedding)::DOUBLE AS value
FROM embeddings
""")
def q_flatten_parallel(spark, sf):
    e = table(spark, sf, "embeddings")
    flat = ingest.flatten_parallel(
        e, [F.sequence(F.lit(0), F.size("embedding") - 1).cast("array<bigint>"), "embedding"],
        ["pos", "value"], keep=["vec_id"])
    return flat.select("vec_id", "pos", F.col("value").cast("double").alias("value"))


# ---------------------------------------------------------------------------
# R: report table

def _orders_report(spark, sf):
    o = table(spark, sf, "orders")
    prof = eda.profile_numeric(o, ["o_totalprice"])
    vc = eda.value_counts(o, "o_orderpriority")
    tt = stats.t_summary(o, "o_totalprice", "o_orderpriority", "1-URGENT", "5-LOW").drop(
        "group_a", "group_b")
    chi = stats.chi_square_summary(o, "o_orderstatus", "o_orderpriority")
    return report.report_table({"profile": (prof, ["column"]),
                                "priority_counts": (vc, ["o_orderpriority"]),
                                "t_test": (tt, []), "chi_square": (chi, [])})


def _report_sql():
    prof_cols = ["n", "n_null", "mean", "stddev", "min", "q1", "median", "q3", "max"]
    prof = ("WITH p AS (SELECT 'o_totalprice' AS item, count(o_totalprice)::DOUBLE AS n, "
            "(count(*) - count(o_totalprice))::DOUBLE AS n_null, avg(o_totalprice) AS mean, "
            "stddev_samp(o_totalprice) AS stddev, min(o_totalprice) AS min, "
            "quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median, "
            "quantile_cont(o_totalprice, 0.75) AS q3, max(o_totalprice) AS max FROM orders), "
            "vc AS (SELECT o_orderpriority AS item, count(*)::DOUBLE AS count, "
            "count(*) / (SELECT count(*) FROM orders) AS share FROM orders GROUP BY 1), "
            f"t AS ({_T_GROUPS_SQL}), "
            "c AS (SELECT o_orderstatus AS a, o_orderpriority AS b, count(*) AS o FROM orders GROUP BY ALL), "
            "r AS (SELECT a, sum(o) AS rt FROM c GROUP BY a), k AS (SELECT b, sum(o) AS ct FROM c GROUP BY b), "
            "tn AS (SELECT sum(o) AS n FROM c), "
            "e AS (SELECT c.o, r.rt * k.ct / tn.n AS e FROM c JOIN r USING (a) JOIN k USING (b), tn), "
            "chi AS (SELECT sum(pow(o - e, 2) / e) AS statistic, "
            "((SELECT count(*) FROM r) - 1) * ((SELECT count(*) FROM k) - 1) AS dof, sum(o) AS n FROM e) ")
    parts = [f"SELECT 'profile' AS section, item, '{m}' AS metric, round({m}::DOUBLE, 6) AS value FROM p"
             for m in prof_cols]
    parts += [f"SELECT 'priority_counts', item, '{m}', round({m}::DOUBLE, 6) FROM vc" for m in ("count", "share")]
    tcols = {"n_a": "n_a", "n_b": "n_b", "mean_a": "mean_a", "mean_b": "mean_b", "var_a": "var_a",
             "var_b": "var_b", "t": "(mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b)",
             "df": "pow(var_a / n_a + var_b / n_b, 2) / (pow(var_a / n_a, 2) / (n_a - 1) "
                   "+ pow(var_b / n_b, 2) / (n_b - 1))"}
    parts += [f"SELECT 't_test', 'all', '{m}', round(({e})::DOUBLE, 6) FROM t" for m, e in tcols.items()]
    parts += [f"SELECT 'chi_square', 'all', '{m}', round({m}::DOUBLE, 6) FROM chi"
              for m in ("statistic", "dof", "n")]
    parts += ["SELECT 'chi_square', 'all', 'n_a', round((SELECT count(*) FROM r)::DOUBLE, 6)",
              "SELECT 'chi_square', 'all', 'n_b', round((SELECT count(*) FROM k)::DOUBLE, 6)"]
    return prof + " UNION ALL ".join(parts)


@register("report", _report_sql())
def q_report(spark, sf):
    r = _orders_report(spark, sf)
    return r.select("section", "item", "metric", F.round("value", 6).alias("value"))


# ---------------------------------------------------------------------------
# S: sources and sinks, as round trips through files Spark writes from the
# tables (into the shared folder the session names in spark.checkpoint.dir)

@register("report_written", _report_sql())
def q_report_written(spark, sf):
    """The report as a file: one csv folder, read back."""
    out = _scratch(spark, "report")
    files.write_table(_orders_report(spark, sf), out, fmt="csv", quoteAll=True)
    back = files.read_table(spark, out, "csv", "section string, item string, metric string, value double")
    return back.select("section", "item", "metric", _r("value"))


def _scratch(spark: SparkSession, name: str) -> str:
    # the session's shared folder; a local session without one gets a fresh one
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("round-trip queries need spark.checkpoint.dir (a shared folder)")
    return f"{base.rstrip('/')}/roundtrip/{name}-{uuid.uuid4().hex}"


_CUSTOMER_DDL = ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                 "c_mktsegment string")


@register("csv_roundtrip", "SELECT * FROM customer")
def q_csv_roundtrip(spark, sf):
    out = _scratch(spark, "customer-csv")
    files.write_table(table(spark, sf, "customer"), out, fmt="csv", partition_by=["c_mktsegment"])
    back = files.read_table(spark, out, "csv", _CUSTOMER_DDL.replace(", c_mktsegment string", ""))
    # the partition column comes back from the folder names
    return back.select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                       F.col("c_mktsegment").cast("string").alias("c_mktsegment"))


@register("null_token_csv", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def q_null_token_csv(spark, sf):
    out = _scratch(spark, "customer-token")
    c = table(spark, sf, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(" ?"))
        .otherwise(F.col("c_mktsegment")))
    files.write_table(c, out, fmt="csv", header=False, ignoreLeadingWhiteSpace=False)
    return files.read_with_null_token(spark, out, _CUSTOMER_DDL)


_ORDER_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")


def _orders_jsonl_with_damage(spark, sf, out):
    """Orders as JSON lines; pending ('P') orders are written damaged: their
    price as text with a unit suffix, and every fourth priority level cut off
    mid-record, so both kinds of bad record occur."""
    o = table(spark, sf, "orders")
    good = F.to_json(F.struct(*[F.col(c) for c in o.columns]))
    wrong_type = F.to_json(F.struct(*[F.col(c) if c != "o_totalprice"
                                      else F.concat(F.col(c).cast("string"), F.lit("usd")).alias(c)
                                      for c in o.columns]))
    broken = F.substring(good, 1, 20)
    line = (F.when(F.col("o_orderstatus") != "P", good)
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", broken)
            .otherwise(wrong_type))
    o.select(line.alias("value")).write.mode("errorifexists").text(out)


@register("quarantine_good", "SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def q_quarantine_good(spark, sf):
    out = _scratch(spark, "orders-jsonl")
    _orders_jsonl_with_damage(spark, sf, out)
    return files.read_with_quarantine(spark, out, _ORDER_DDL, "json")[0]


@register("quarantine_bad", """
SELECT count(*) AS n_bad, count(DISTINCT o_orderpriority) AS n_priorities
FROM orders WHERE o_orderstatus = 'P'
""")
def q_quarantine_bad(spark, sf):
    out = _scratch(spark, "orders-jsonl-bad")
    _orders_jsonl_with_damage(spark, sf, out)
    bad = files.read_with_quarantine(spark, out, _ORDER_DDL, "json")[1]
    prio = F.regexp_extract("_raw", r'"o_orderpriority":"([^"]*)"', 1)
    cut = F.lit("4-NOT SPECIFIED")
    return bad.agg(F.count(F.lit(1)).alias("n_bad"),
                   F.count_distinct(F.when(prio != "", prio).otherwise(cut)).alias("n_priorities"))


@register("json_roundtrip", "SELECT * FROM orders")
def q_json_roundtrip(spark, sf):
    out = _scratch(spark, "orders-json")
    files.write_table(table(spark, sf, "orders"), out, fmt="json")
    return files.read_table(spark, out, "json", _ORDER_DDL)


@register("parquet_roundtrip", "SELECT * FROM orders")
def q_parquet_roundtrip(spark, sf):
    out = _scratch(spark, "orders-parquet")
    files.write_table(table(spark, sf, "orders"), out, partition_by=["o_orderstatus"])
    back = files.read_table(spark, out)
    return back.select("o_orderkey", "o_custkey", F.col("o_orderstatus").cast("string").alias("o_orderstatus"),
                       "o_totalprice", "o_orderdate", "o_orderpriority")


def _customers_csv_with_damage(spark, sf, out):
    """Customers as csv with a header; some have a field too many, some a word for a number."""
    c = table(spark, sf, "customer")
    line = lambda bal: F.concat_ws(",", "c_custkey", "c_name", "c_nationkey", bal, "c_mktsegment")
    k = F.col("c_custkey") % 20
    value = (F.when(k == 0, F.concat(line(F.col("c_acctbal")), F.lit(",extra")))
             .when(k == 1, line(F.lit("much"))).otherwise(line(F.col("c_acctbal"))))
    c.select(value.alias("c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment")).write.option("header", True) \
     .option("quote", "").option("sep", "\x01").csv(out)


@register("quarantine_csv", """
SELECT 'good' AS part, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer WHERE c_custkey % 20 > 1
UNION ALL
SELECT 'bad', count(*), sum(c_custkey)::BIGINT FROM customer WHERE c_custkey % 20 <= 1
""")
def q_quarantine_csv(spark, sf):
    out = _scratch(spark, "customer-csv-damage")
    _customers_csv_with_damage(spark, sf, out)
    good, bad = files.read_with_quarantine(spark, out, _CUSTOMER_DDL, "csv")
    key = F.regexp_extract("_raw", "^([0-9]+),", 1).cast("bigint")
    sums = [df.agg(F.count("*").alias("n"), F.sum(c).alias("keys")).select(F.lit(name).alias("part"), "n", "keys")
            for name, df, c in (("good", good, F.col("c_custkey")), ("bad", bad, key))]
    return sums[0].unionByName(sums[1])


# Every rule fails at least one row here: values are damaged by key.
@register("rules_all_fail", """
WITH r(rule, k) AS (VALUES ('typed', 1), ('typed_double', 2), ('required', 3), ('in_range', 4), ('one_of', 5),
                           ('matches', 6), ('check', 7))
SELECT r.rule, count(*) AS n_failed FROM r JOIN customer ON c_custkey % 10 = r.k GROUP BY r.rule
""")
def q_rules_all_fail(spark, sf):
    k = F.col("c_custkey") % 10
    c = table(spark, sf, "customer").select(
        F.when(k == 1, "x1").otherwise(F.col("c_custkey").cast("string")).alias("key"),
        F.when(k == 2, "1.2.3").otherwise("1.5e3").alias("amount"),
        F.when(k == 3, None).otherwise(F.col("c_name")).alias("name"),
        F.when(k == 4, 1e9).otherwise(1.0).alias("balance"),
        F.when(k == 5, "NONE").otherwise("A").alias("segment"),
        F.when(k == 6, "ab").otherwise("AB").alias("code"),
        F.when(k == 7, 2).otherwise(1).alias("low"), F.lit(1).alias("high"))
    checks = [rules.typed("key", "bigint", name="typed"), rules.typed("amount", "double", name="typed_double"),
              rules.required("name", name="required"), rules.in_range("balance", 0, 1000, name="in_range"),
              rules.one_of("segment", ["A"], name="one_of"), rules.matches("code", "^[A-Z]+$", name="matches"),
              rules.check("check", F.col("low") <= F.col("high"))]
    return validate.error_summary(c, checks).select("rule", "n_failed")


@register("payload_read", """
SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k, true AS _parsed FROM events
""")
def q_payload_read(spark, sf):
    out = _scratch(spark, "events-payloads")
    ev = table(spark, sf, "events")
    ev.select(F.to_json(F.struct("event_id", F.from_json("props", "k int").alias("p"))).alias("value")) \
      .write.mode("errorifexists").text(out)
    p = files.read_payloads(spark, out, "event_id bigint, p struct<k: int>")
    return p.select("event_id", F.col("p.k").alias("k"), "_parsed")


# ---------------------------------------------------------------------------
# Streams: the same rules and flags on Structured Streaming, over files Spark
# lands from the tables into the shared folder (whole tables, availableNow)

@register("stream_validate", f"""
SELECT c_custkey, array_to_string({_CUSTOMER_ERRORS_SQL}, '|') AS errors,
       CASE WHEN len({_CUSTOMER_ERRORS_SQL}) = 0 THEN 'valid' ELSE 'rejected' END AS status
FROM customer
""")
def q_stream_validate(spark, sf):
    base = _scratch(spark, "customer-stream")
    c = table(spark, sf, "customer")
    c.select(F.to_json(F.struct(*c.columns)).alias("value")).write.mode("errorifexists").text(f"{base}/in")
    s = stream.validated_stream(spark, f"{base}/in", _CUSTOMER_DDL, customer_rules())
    q = stream.write_split_stream(s.drop("_raw"), f"{base}/out", name="stream_validate",
                                  checkpoint=f"{base}/checkpoint")
    q.awaitTermination()
    back = spark.read.parquet(f"{base}/out")
    return back.select("c_custkey", F.array_join("errors", "|").alias("errors"),
                       F.col("status").cast("string").alias("status"))


@register("stream_outlier_windows", f"""
WITH b AS (SELECT event_type, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
           FROM ({_EV_BOUNDS_G}))
SELECT date_trunc('day', e.ts) AS window_start, date_trunc('day', e.ts) + INTERVAL 1 DAY AS window_end,
       e.event_type, count(*) AS n_rows,
       count_if(NOT (CASE WHEN isnan(e.value) THEN NULL ELSE e.value END BETWEEN b.lower AND b.upper))::BIGINT
         AS n_outliers
FROM events e LEFT JOIN b ON e.event_type IS NOT DISTINCT FROM b.event_type
WHERE e.ts IS NOT NULL
GROUP BY ALL
""")
def q_stream_outlier_windows(spark, sf):
    base = _scratch(spark, "events-stream")
    ev = table(spark, sf, "events")
    ev.write.mode("errorifexists").parquet(f"{base}/in")
    bounds = outliers.iqr_bounds(ev, "value", by=["event_type"])
    s = spark.readStream.schema(ev.schema).parquet(f"{base}/in")
    flagged = stream.flag_stream(s.where(F.col("ts").isNotNull()), bounds, "value", by=["event_type"])
    counts = stream.windowed_outlier_counts(flagged, "ts", window="1 day", watermark="1 day",
                                            by=["event_type"])
    q = stream.write_update_log(counts, f"{base}/out", name="stream_outlier_windows",
                                checkpoint=f"{base}/checkpoint")
    q.awaitTermination()
    latest = stream.read_update_log(spark, f"{base}/out", keys=["window", "event_type"])
    return latest.select(F.col("window.start").alias("window_start"),
                         F.col("window.end").alias("window_end"),
                         "event_type", "n_rows", "n_outliers")


# ---------------------------------------------------------------------------
# Composed plans on payloads and features Spark derives from the tables

def _country_code(k: Column) -> Column:
    return F.concat(F.chr(F.lit(65) + k % 26), F.chr(F.lit(65) + F.floor(k / 26) % 26))


def _land_collection_payloads(spark, sf, base):
    """Weather documents (one per event, two hourly steps), country facts (one
    per nation) and IP-location answers (one per customer) as JSON lines. Some of
    each kind are damaged: cut off, without their arrays, or of a wrong type."""
    def cut(line):
        return F.substring(line, 1, 25)

    ev = table(spark, sf, "events")
    fmt = "yyyy-MM-dd'T'HH:mm"
    hourly = F.struct(
        F.array(F.date_format("ts", fmt), F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"), fmt))
        .alias("time"),
        F.array(F.col("value") / 4 - 50, F.col("value") / 4 - 51).alias("temperature_2m"))
    place = [((F.col("user_id") % 191) - 95).cast("double").alias("latitude"),
             ((F.col("event_id") % 361) - 180).cast("double").alias("longitude")]
    sound = F.to_json(F.struct(*place, hourly.alias("hourly")))
    wrong = F.to_json(F.struct(*place, F.lit("none").alias("hourly")))
    kind = F.col("event_id") % 50
    ev.select(F.when(kind == 0, cut(sound)).when(kind == 1, F.to_json(F.struct(*place)))
              .when(kind == 2, wrong).otherwise(sound).alias("value")) \
      .write.mode("errorifexists").text(f"{base}/weather")
    nat = table(spark, sf, "nation")
    country = F.to_json(F.struct(_country_code(F.col("n_nationkey")).alias("code"), F.col("n_name").alias("name"),
                                 ((F.col("n_nationkey") + 1) * 1000000).cast("long").alias("population")))
    nat.select(F.when(F.col("n_nationkey") % 8 == 3, cut(country)).otherwise(country).alias("value")).write.mode("errorifexists").text(f"{base}/countries")
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    ip = F.concat_ws(".", F.lit("10"), (F.floor(k / 65536) % 256).cast("string"),
                     (F.floor(k / 256) % 256).cast("string"), (k % 256).cast("string"))
    code = _country_code(F.col("c_nationkey"))
    answer = F.to_json(F.struct(
        ip.alias("query"),
        F.when(F.col("c_acctbal") >= 0, "success").otherwise("fail").alias("status"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lower(code)).otherwise(code).alias("countryCode"),
        (F.col("c_acctbal") / 100).alias("lat"), F.col("c_nationkey").cast("double").alias("lon")))
    c.select(F.when(k % 40 == 0, cut(answer)).otherwise(answer).alias("value")) \
     .write.mode("errorifexists").text(f"{base}/ip")


_CODE_SQL = "chr(65 + ({k}) % 26) || chr(65 + (({k}) // 26) % 26)"


@register("collect_job", f"""
WITH steps AS (
  SELECT ts, (user_id % 191) - 95 AS latitude, (event_id % 361) - 180 AS longitude,
         value / 4 - 50 AS t FROM events WHERE event_id % 50 > 2
  UNION ALL
  SELECT ts + INTERVAL 1 HOUR, (user_id % 191) - 95, (event_id % 361) - 180, value / 4 - 51 FROM events
  WHERE event_id % 50 > 2),
w AS (
  SELECT 'rejected' AS status FROM events WHERE event_id % 50 <= 2
  UNION ALL
  SELECT CASE WHEN ts IS NOT NULL AND t IS NOT NULL AND coalesce(t BETWEEN -90 AND 60, true)
              AND coalesce(latitude BETWEEN -90 AND 90, true) AND coalesce(longitude BETWEEN -180 AND 180, true)
         THEN 'valid' ELSE 'rejected' END AS status FROM steps),
ctry AS (SELECT {_CODE_SQL.format(k="n_nationkey")} AS code, n_name AS name FROM nation WHERE n_nationkey % 8 <> 3),
ip AS (
  SELECT CASE WHEN c_acctbal >= 0 THEN 'success' ELSE 'fail' END AS status,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN lower({_CODE_SQL.format(k="c_nationkey")})
              ELSE {_CODE_SQL.format(k="c_nationkey")} END AS country_code FROM customer WHERE c_custkey % 40 <> 0),
l AS (
  SELECT 'rejected' AS status FROM customer WHERE c_custkey % 40 = 0
  UNION ALL
  SELECT CASE WHEN coalesce(ip.status IN ('success'), true) AND ip.country_code IS NOT NULL
              AND coalesce(regexp_matches(ip.country_code, '^[A-Z]{{2}}$'), true) AND ctry.name IS NOT NULL
         THEN 'valid' ELSE 'rejected' END AS status
  FROM ip LEFT JOIN ctry ON ip.country_code = ctry.code)
SELECT 'weather' AS dataset, status, count(*) AS rows FROM w GROUP BY status
UNION ALL
SELECT 'countries', CASE WHEN n_nationkey % 8 = 3 THEN 'rejected' ELSE 'valid' END, count(*) FROM nation GROUP BY ALL
UNION ALL
SELECT 'locations', status, count(*) FROM l GROUP BY status
""")
def q_collect_job(spark, sf):
    base = _scratch(spark, "collection")
    _land_collection_payloads(spark, sf, f"{base}/landed")
    return collect_job.run(spark, f"{base}/landed/weather", f"{base}/landed/countries",
                           f"{base}/landed/ip", f"{base}/out")


def _analysis_sql() -> str:
    share = "length(regexp_replace(d.text, '{}', '', 'g')) / greatest(length(d.text), 1)"
    parts = [f"""SELECT 'validation' AS section, '{rule}' AS item, m AS metric, v::DOUBLE AS value FROM (
               SELECT unnest(['n_failed', 'n_rows']) AS m, unnest([count_if({bad}), count(*)]) AS v FROM f)"""
             for rule, bad in (("required:lang", "lang IS NULL"), ("in_range:upper_share", "NOT upper_share BETWEEN 0 AND 1"),
                               ("has_words", "NOT n_words > 0"))]
    parts.append("""SELECT 'outliers:n_words', 'all', m, v FROM (
        SELECT unnest(['n_rows', 'n_kept', 'n_outliers', 'n_null', 'lower', 'upper']) AS m,
               unnest([count(*)::DOUBLE, count_if(n_words BETWEEN lo AND hi), count_if(NOT n_words BETWEEN lo AND hi),
                       count_if(n_words IS NULL), max(lo), max(hi)]) AS v FROM v, b)""")
    for c in _NUMERIC_FEATURES:
        q = [f"quantile_cont({c}, {p})" for p in (0.25, 0.5, 0.75)]
        parts.append(f"""SELECT 'profile', '{c}', m, v FROM (
            SELECT unnest(['n', 'n_null', 'mean', 'stddev', 'min', 'q1', 'median', 'q3', 'max']) AS m,
                   unnest([count({c})::DOUBLE, count(*) - count({c}), avg({c}), stddev_samp({c}), min({c}), {', '.join(q)}, max({c})]) AS v
            FROM v)""")
        parts.append(f"""SELECT 't_test:{c}', 'all', m, x FROM (
            SELECT unnest(['n_a', 'n_b', 'mean_a', 'mean_b', 'var_a', 'var_b', 't', 'df']) AS m,
                   unnest([na::DOUBLE, nb, ma, mb, va, vb, (ma - mb) / sqrt(va / na + vb / nb),
                           pow(va / na + vb / nb, 2) / (pow(va / na, 2) / (na - 1) + pow(vb / nb, 2) / (nb - 1))]) AS x
            FROM (SELECT count({c}) FILTER (WHERE label = 1) AS na, count({c}) FILTER (WHERE label = 0) AS nb,
                         avg({c}) FILTER (WHERE label = 1) AS ma, avg({c}) FILTER (WHERE label = 0) AS mb,
                         var_samp({c}) FILTER (WHERE label = 1) AS va, var_samp({c}) FILTER (WHERE label = 0) AS vb FROM v))""")
    for c in ("lang", "source"):
        parts.append(f"""SELECT 'rate:{c}', {c}, m, x FROM (
            SELECT {c}, unnest(['n', 'n_flag', 'rate']) AS m, unnest([count(label)::DOUBLE, sum(label), avg(label)]) AS x FROM v GROUP BY {c})""")
        parts.append(f"""SELECT 'chi_square:{c}', 'all', m, x FROM (
            SELECT unnest(['statistic', 'dof', 'n']) AS m, unnest([sum(pow(o - e, 2) / e), (count(DISTINCT a) - 1.0) * (count(DISTINCT b) - 1), sum(o)]) AS x
            FROM (SELECT a, b, coalesce(o, 0) AS o, rt * ct / (SELECT count(*) FROM v WHERE {c} IS NOT NULL AND label IS NOT NULL) AS e
                  FROM (SELECT {c} AS a, count(*) AS rt FROM v WHERE label IS NOT NULL GROUP BY {c}) r
                  CROSS JOIN (SELECT label AS b, count(*) AS ct FROM v WHERE {c} IS NOT NULL GROUP BY label) k
                  LEFT JOIN (SELECT {c} AS a, label AS b, count(*) AS o FROM v GROUP BY ALL) USING (a, b)
                  WHERE a IS NOT NULL AND b IS NOT NULL))""")
    return f"""
WITH f AS (
  SELECT d.doc_id, l.quality::DOUBLE AS label, d.lang, d.source, d.n_chars::DOUBLE AS n_chars,
         len(list_filter(regexp_split_to_array(d.text, '[ \\t\\n\\r]+'), lambda x: x <> ''))::DOUBLE AS n_words,
         len(string_split(d.text, chr(10)))::DOUBLE AS n_lines, {share.format('[^A-Z]')} AS upper_share,
         {share.format('[^0-9]')} AS digit_share, {share.format('[^!?.]')} AS punct_share
  FROM documents d JOIN labels l USING (doc_id)),
v AS (SELECT * FROM f WHERE lang IS NOT NULL AND upper_share BETWEEN 0 AND 1 AND n_words > 0),
b AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
      FROM (SELECT quantile_cont(n_words, 0.25) AS q1, quantile_cont(n_words, 0.75) AS q3 FROM v))
SELECT section, item, metric, round(value, 6) AS value FROM ({" UNION ALL ".join(parts)}) x(section, item, metric, value)"""


@register("analysis_run", _analysis_sql())
def q_analysis_run(spark, sf):
    """All sections but the fitted models; p-values have their own queries (``t_test_p``, ``chi_square_p``)."""
    spec = analysis.AnalysisSpec(
        label=F.col("label"), key="doc_id", numeric=_NUMERIC_FEATURES, categorical=["lang", "source"],
        rules=[rules.required("lang"), rules.in_range("upper_share", 0, 1),
               rules.check("has_words", F.col("n_words") > 0)],
        outlier_columns=["n_words"], fit_models=False)
    got = analysis.run_analysis(document_features(spark, sf), spec).where("metric <> 'p'")
    return got.select("section", "item", "metric", _r("value"))
