"""Classifier pipelines on ``pyspark.ml``: split, preprocess, fit, compare.

* ``split`` is a hash of the key and a salt, so a row's side does not depend
  on partitioning or on the order rows arrive in (``randomSplit`` does).
* ``preprocess`` returns unfitted stages (impute, index, one-hot, assemble,
  scale); they are fitted on the training part only, inside the model pipeline.
* ``fit_features`` does the same with its fitted state in tables: exact medians, and for each
  category a dictionary ranked by frequency that rows are joined to. No list of categories
  reaches the driver, so a column may have millions.
* ``binary_metrics`` is one aggregate over the predictions plus the exact area
  under the ROC curve from ``BinaryClassificationEvaluator`` (no binning).
* ``score_models`` fits each estimator on the same cached training part and writes the scores of
  the same cached test part as one table of predictions by model and key;
  ``prediction_metrics`` computes confusion, exact AUC (rank sums with ties, over range
  partitions) and rank of all models from such a table; ``compare_models`` is the two together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import keep, materialize
from .joins import join_small
from .ordinal import running_before
from .quantiles import clean_value, exact_values_wide

SPLIT_BUCKETS = 10000


def split(df: DataFrame, key: str | Sequence[str], test_share: float = 0.2,
          salt: int = 0) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` by ``pmod(xxhash64(key, salt), 10000)``."""
    keys = [key] if isinstance(key, str) else list(key)
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(salt)), F.lit(SPLIT_BUCKETS))
    cut = int(round(test_share * SPLIT_BUCKETS))
    return df.where(bucket >= cut), df.where(bucket < cut)


def preprocess(numeric: Sequence[str], categorical: Sequence[str],
               features: str = "features", scale: bool = True) -> list:
    """Unfitted stages turning raw columns into one ``features`` vector.

    Numeric columns: median imputation (then standard scaling). Categorical
    columns: index by frequency, unseen and null values go to an extra
    index (``handleInvalid='keep'``), then one-hot.
    """
    numeric, categorical = list(numeric), list(categorical)
    stages: list = []
    num_out = [f"{c}__imp" for c in numeric]
    if numeric:
        stages.append(Imputer(inputCols=numeric, outputCols=num_out, strategy="median"))
    idx_out = [f"{c}__idx" for c in categorical]
    oh_out = [f"{c}__oh" for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=idx_out,
                                    handleInvalid="keep", stringOrderType="frequencyDesc"))
        stages.append(OneHotEncoder(inputCols=idx_out, outputCols=oh_out, handleInvalid="keep"))
    raw = features if not scale else f"{features}__raw"
    stages.append(VectorAssembler(inputCols=num_out + oh_out, outputCol=raw, handleInvalid="keep"))
    if scale:
        stages.append(StandardScaler(inputCol=raw, outputCol=features, withMean=False, withStd=True))
    return stages


def category_dictionary(df: DataFrame, col: str) -> DataFrame:
    """``value, count, index``: the distinct values of a column as text, ranked from 0 by falling frequency, then value.

    Nulls have no entry. The rank is a range partition's offset and the place inside it.
    """
    counts = df.select(F.col(f"`{col}`").cast("string").alias("value")).where("value is not null").groupBy("value").agg(
        F.count(F.lit(1)).alias("count"))
    return running_before(counts, [F.desc("count"), F.asc("value")], name="index")


@dataclass
class Features:
    """Fitted preprocessing: medians and deviations of numeric columns, dictionaries of categories."""

    numeric: dict[str, tuple[float, float]]
    dictionaries: dict[str, DataFrame]
    sizes: dict[str, int]

    def columns(self, df: DataFrame) -> DataFrame:
        """``df`` with ``<c>__num`` (median where null or NaN, over the deviation) and ``<c>__idx`` columns.

        A category that the dictionary does not hold, or null, has the index after the last.
        """
        out = df
        for c, (median, deviation) in self.numeric.items():
            out = out.withColumn(f"{c}__num", F.coalesce(clean_value(f"`{c}`"), F.lit(median)) / F.lit(deviation or 1.0))
        for c, values in self.dictionaries.items():
            side = values.select(F.col("value").alias(f"{c}__key"), F.col("index").alias(f"{c}__idx"))
            out = join_small(out.withColumn(f"{c}__key", F.col(f"`{c}`").cast("string")), side, [f"{c}__key"], "left", null_safe=False)
            out = out.drop(f"{c}__key").withColumn(f"{c}__idx", F.coalesce(f"{c}__idx", F.lit(self.sizes[c])).cast("double"))
        return out

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with one vector: the numeric columns, then each category one-hot (sparse)."""
        out = self.columns(df)
        index, hot = [f"{c}__idx" for c in self.dictionaries], [f"{c}__hot" for c in self.dictionaries]
        if index:
            # The encoder only needs the number of indexes of each column: one row of the greatest.
            last = df.sparkSession.createDataFrame([tuple(float(n) for n in self.sizes.values())], index)
            out = OneHotEncoder(inputCols=index, outputCols=hot, handleInvalid="keep").fit(last).transform(out)
        parts = [f"{c}__num" for c in self.numeric]
        out = VectorAssembler(inputCols=parts + hot, outputCol=features, handleInvalid="keep").transform(out)
        return out.drop(*parts, *index, *hot)


def fit_features(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Features:
    """Fit :class:`Features` on the training part; only medians, deviations and dictionary sizes reach the driver.

    A numeric column without values has median 0; one without spread is left unscaled. Deviations are those of the imputed column.
    """
    numeric, categorical = list(numeric), list(categorical)
    medians = [q[0] if q[0] is not None else 0.0 for _, q, _ in exact_values_wide(train, [F.col(f"`{c}`") for c in numeric], [0.5])]
    spread: list = []
    if numeric:
        spread = list(train.agg(*[F.stddev_samp(F.coalesce(clean_value(f"`{c}`"), F.lit(m))) for c, m in zip(numeric, medians, strict=True)]).first())
    dictionaries = {c: materialize(category_dictionary(train, c)) for c in categorical}
    return Features({c: (m, s or 1.0) for c, m, s in zip(numeric, medians, spread, strict=True)}, dictionaries,
                    {c: d.count() for c, d in dictionaries.items()})


def default_estimators(label: str = "label", features: str = "features", seed: int = 42) -> dict:
    """The three compared models: a linear one and two tree ensembles."""
    return {
        "logistic_regression": LogisticRegression(labelCol=label, featuresCol=features,
                                                  maxIter=50, regParam=0.01),
        "random_forest": RandomForestClassifier(labelCol=label, featuresCol=features,
                                                numTrees=30, maxDepth=6, seed=seed),
        "gradient_boosted_trees": GBTClassifier(labelCol=label, featuresCol=features,
                                                maxIter=20, maxDepth=4, seed=seed),
    }


def fit_model(train: DataFrame, stages: list, estimator) -> PipelineModel:
    return Pipeline(stages=list(stages) + [estimator]).fit(train)


def _score(pred: DataFrame, probability: str) -> DataFrame:
    return pred.withColumn("__score", vector_to_array(F.col(probability))[1])


def binary_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                   score: str | None = None, probability: str | None = "probability") -> DataFrame:
    """One row: ``n, n_pos, accuracy, precision, recall, f1, auc, majority_accuracy``.

    ``score`` names a numeric column ranking rows (higher = more positive);
    otherwise the positive-class probability is used. Precision is null when
    nothing is predicted positive, recall when there is no positive label.
    """
    if score is None:
        pred = _score(pred, probability)
        score = "__score"
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    m = pred.agg(F.count(F.lit(1)).alias("n"), F.count_if(y == 1).alias("n_pos"),
                 F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if(y == p).alias("correct"))
    auc = BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label,
                                        metricName="areaUnderROC", numBins=0).evaluate(
        pred.select(F.col(score).cast("double").alias(score), y.alias(label)))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp")))
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn")))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec))
    n = F.col("n")
    return m.select("n", "n_pos", (F.col("correct") / n).alias("accuracy"), prec.alias("precision"),
                    rec.alias("recall"), f1.alias("f1"), F.lit(auc).alias("auc"),
                    (F.greatest(F.col("n_pos"), n - F.col("n_pos")) / n).alias("majority_accuracy"))


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``label, prediction, count``."""
    return pred.groupBy(F.col(label).cast("double").alias("label"),
                        F.col(prediction).cast("double").alias("prediction")).agg(
        F.count(F.lit(1)).alias("count"))


def _features_col(stages: list) -> str:
    """The column the last preprocessing stage writes (the features vector)."""
    last = stages[-1]
    return last.getOutputCol()


class MedianRule:
    """A rule on one numeric column: the score grows from the middle of the two classes' exact medians towards label 1's."""

    def __init__(self, col: str, label: str = "label") -> None:
        self.col, self.label = col, label

    def fit(self, train: DataFrame) -> MedianRule:
        v = clean_value(f"`{self.col}`")
        sides = [F.when(F.col(self.label) == k, v) for k in (1, 0)]
        one, zero = (q[0] if q[0] is not None else 0.0 for _, q, _ in exact_values_wide(train, sides, [0.5]))
        fitted = MedianRule(self.col, self.label)
        fitted.middle, fitted.sign, fitted.gap = (one + zero) / 2, float((one > zero) - (one < zero)), abs(one - zero) or 1.0
        return fitted

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (a number; 0.5 for a null value) and ``prediction``."""
        z = F.coalesce((clean_value(f"`{self.col}`") - self.middle) * self.sign / self.gap, F.lit(0.0))
        p = 0.5 + 0.5 * z / (1 + F.abs(z))
        return df.withColumn("probability", p).withColumn("prediction", (F.col("probability") >= 0.5).cast("double"))


class CategoryRate:
    """The share of label 1 in a row's category, with one row of each label added; 0.5 for unseen and null ones."""

    def __init__(self, col: str, label: str = "label") -> None:
        self.col, self.label = col, label

    def fit(self, train: DataFrame) -> CategoryRate:
        fitted = CategoryRate(self.col, self.label)
        y = F.col(self.label)
        fitted.rates = materialize(train.where(F.col(f"`{self.col}`").isNotNull()).groupBy(F.col(f"`{self.col}`").alias(self.col)).agg(
            ((F.count_if(y == 1) + 1) / (F.count(F.lit(1)) + 2)).alias("__rate")))
        return fitted

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (a number) and ``prediction``."""
        out = join_small(df, self.rates, [self.col], "left", null_safe=False).withColumn("probability", F.coalesce("__rate", F.lit(0.5)))
        return out.drop("__rate").withColumn("prediction", (F.col("probability") >= 0.5).cast("double"))


def score_models(train: DataFrame, test: DataFrame, estimators: Mapping[str, object], key: str, label: str = "label") -> DataFrame:
    """``model, key, label, score, prediction`` for each estimator fitted on ``train`` and each row of ``test``.

    ``score`` is the probability of label 1. An estimator is anything with ``fit``, whose model's ``transform`` adds
    ``prediction`` and ``probability`` (a vector, or a number for label 1).
    """
    out = None
    for name, estimator in estimators.items():
        got = estimator.fit(train).transform(test)
        p = F.col("probability") if got.schema["probability"].dataType.typeName() == "double" else vector_to_array("probability")[1]
        own = got.select(F.lit(name).alias("model"), F.col(f"`{key}`").alias("key"), F.col(label).cast("double").alias("label"),
                         p.alias("score"), F.col("prediction").cast("double").alias("prediction"))
        out = own if out is None else out.unionByName(own)
    return out


def prediction_metrics(scored: DataFrame) -> DataFrame:
    """One row per model of ``scored(model, label, score, prediction)``, ranked by AUC, then name.

    ``rank, model, n, n_pos, tp, fp, fn, tn, accuracy, precision, recall, f1, auc, majority_accuracy``. The AUC is the share
    of pairs of a positive and a negative row that the score orders rightly, ties counting half; null without such pairs.
    """
    y, p = F.col("label"), F.col("prediction")
    counts = scored.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(y == 1).alias("n_pos"), F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"), F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if(y == 0).alias("n_neg"))
    ties = scored.groupBy("model", "score").agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    below = running_before(ties, [F.asc("score")], F.col("neg"), ["model"])
    pairs = below.groupBy("model").agg(F.sum(F.col("pos").cast("decimal(38,1)") * (F.col("before") + F.col("neg") / F.lit(2).cast("decimal(2,0)")))
                                       .cast("double").alias("won"))
    out = counts.join(pairs, "model").withColumn("auc", F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.col("won") / (
        F.col("n_pos").cast("double") * F.col("n_neg"))))
    tp, fp, fn, n = (F.col(c) for c in ("tp", "fp", "fn", "n"))
    order = Window.orderBy(F.desc_nulls_last("auc"), "model")  # one row a model
    return out.select(
        F.row_number().over(order).alias("rank"), "model", "n", "n_pos", "tp", "fp", "fn", "tn",
        ((tp + F.col("tn")) / n).alias("accuracy"), F.when(tp + fp > 0, tp / (tp + fp)).alias("precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).alias("recall"), F.when(tp > 0, 2 * tp / (2 * tp + fp + fn)).alias("f1"), "auc",
        (F.greatest(F.col("n_pos"), n - F.col("n_pos")) / n).alias("majority_accuracy"))


def compare_models(train: DataFrame, test: DataFrame, stages: list | Features | None = None,
                   estimators: Mapping[str, object] | None = None, label: str = "label",
                   order_key: str | None = None, partitions: int = 64, predictions: str | None = None) -> DataFrame:
    """One row per model, as :func:`prediction_metrics`.

    ``stages`` are unfitted ``pyspark.ml`` stages, a fitted :class:`Features`, or None where the estimators take the columns as they are.
    Train and test are cached once for all models. With ``order_key`` the
    training rows are hash-partitioned into ``partitions`` and sorted by it first. The
    tree learners sample rows by partition, so the result is repeatable for a
    given ``partitions``, whatever the cluster's own settings; raise it with the data.
    The table of predictions is written to ``predictions`` if given (Parquet, partitioned by model), else kept in the
    session's checkpoint folder; all figures are computed from it.
    """
    estimators = dict(estimators or default_estimators(label))
    # The preprocessing is fitted once, on the training part only, and both parts are reduced to (key, label,
    # features) and cached: every model then trains on the same compact vectors.
    if stages is not None:
        prep, features = (stages, "features") if isinstance(stages, Features) else (Pipeline(stages=list(stages)).fit(train), _features_col(stages))
        cols = [c for c in dict.fromkeys([order_key, label, features]) if c is not None]
        train, test = prep.transform(train).select(*cols), prep.transform(test).select(*cols)
    if order_key is not None:
        train = train.repartition(partitions, order_key).sortWithinPartitions(order_key)
    train, test = keep(train), keep(test)
    key = order_key
    if key is None:
        key, test = "__row", test.withColumn("__row", F.lit(None).cast("bigint"))
    try:
        scored = score_models(train, test, estimators, key, label)
        if predictions is None:
            scored = materialize(scored)
        else:
            scored.write.partitionBy("model").parquet(predictions)
            scored = train.sparkSession.read.parquet(predictions)
    finally:
        train.unpersist()
        test.unpersist()
    return prediction_metrics(scored)
