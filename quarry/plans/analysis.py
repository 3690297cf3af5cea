"""The analysis run: validate, flag outliers, profile, test, compare models, report.

``run_analysis`` composes the operators over one table described by an
``AnalysisSpec`` and returns the long report table
``section, item, metric, value``. Each part is a distributed job; only the
model fits and the one-row test summaries are actions of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule
from ..operators import eda, models, outliers, stats
from ..operators.report import report_table
from ..operators.validate import error_summary, split_valid
from ..session import keep


@dataclass
class AnalysisSpec:
    label: Column                      # 0/1 (double) outcome
    key: str                           # row identity, for the repeatable split
    numeric: Sequence[str]
    categorical: Sequence[str]
    rules: Sequence[Rule] = field(default_factory=list)
    outlier_columns: Sequence[str] = ()
    fit_models: bool = True
    test_share: float = 0.2
    salt: int = 0


def run_analysis(df: DataFrame, spec: AnalysisSpec) -> DataFrame:
    data = df.withColumn("label", spec.label.cast("double"))
    # The used columns and one flag a rule are computed once and kept: columns may be costly
    # (features of texts), and every part below takes passes of its own.
    used = dict.fromkeys([spec.key, "label", *spec.numeric, *spec.categorical, *spec.outlier_columns])
    flagged = [Rule(r.name, F.col(f"__bad{i}")) for i, r in enumerate(spec.rules)]
    data = keep(data.select(*[F.col(f"`{c}`") for c in used], *[r.bad.alias(f"__bad{i}") for i, r in enumerate(spec.rules)]))
    parts: dict = {}
    if flagged:
        parts["validation"] = (error_summary(data, flagged).drop("rule_pos"), ["rule"])
        data = split_valid(data, flagged)[0]
    # Columns of a kind share their passes: one sketch, one set of sums, one set of cells.
    data = data.select(*[F.col(f"`{c}`") for c in used])
    for c in spec.outlier_columns:
        parts[f"outliers:{c}"] = (outliers.outlier_report(data, c), [])
    if spec.numeric:
        parts["profile"] = (eda.profile_numeric(data, spec.numeric), ["column"])
    if spec.categorical:
        cells = keep(eda.cell_counts(data, spec.categorical, "label"))
        for c in spec.categorical:
            own = cells.where(F.col("column") == c)
            seen = F.sum(F.when(F.col("label").isNotNull(), F.col("count")))
            rate = own.groupBy(F.col("value").alias(c)).agg(
                F.coalesce(seen, F.lit(0)).alias("n"), F.sum(F.col("label") * F.col("count")).cast("long").alias("n_flag"),
                (F.sum(F.col("label") * F.col("count")) / seen).alias("rate"))
            parts[f"rate:{c}"] = (rate, [c])
            parts[f"chi_square:{c}"] = (stats.chi_square_of_cells(own, "value", "label", "count").drop("n_a", "n_b"), [])
    if spec.numeric:
        t = keep(stats.t_tests(data, spec.numeric, "label", 1.0, 0.0).drop("group_a", "group_b"))  # one row a column
        for c in spec.numeric:
            parts[f"t_test:{c}"] = (t.where(F.col("column") == c).drop("column"), [])
    if spec.fit_models:
        train, test = models.split(data, spec.key, spec.test_share, spec.salt)
        stages = models.preprocess(list(spec.numeric), list(spec.categorical))
        parts["models"] = (models.compare_models(train, test, stages, order_key=spec.key), ["model"])
    return report_table(parts)


def census_spec(rules: Sequence[Rule] = ()) -> AnalysisSpec:
    """Spec for census-income style tables (income label ``>50K`` / ``<=50K``).

    The label text may carry a trailing dot (the test file's convention).
    """
    income = F.regexp_replace(F.trim(F.col("income")), r"\.$", "")
    return AnalysisSpec(
        label=F.when(income == ">50K", 1.0).when(income == "<=50K", 0.0),
        key="row_id",
        numeric=["age", "fnlwgt", "education_num", "capital_gain", "capital_loss", "hours_per_week"],
        categorical=["workclass", "education", "marital_status", "occupation", "relationship",
                     "race", "sex", "native_country"],
        rules=list(rules), outlier_columns=["hours_per_week"])
