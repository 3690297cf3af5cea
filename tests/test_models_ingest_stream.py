"""Models, payload ingest, the collection job, the analysis run and streaming."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from quarry import registry
from quarry.functions import rules as R
from quarry.operators import ingest as J
from quarry.operators import models as M
from quarry.operators import outliers as O
from quarry.plans import analysis, collect_job
from quarry.streaming import stream as ST


def _lines(path, docs):
    with open(path, "w") as fh:
        for d in docs:
            fh.write((d if isinstance(d, str) else json.dumps(d)) + "\n")
    return path


def test_split_repeatable_and_partition_free(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id")
    a_train, a_test = M.split(d, "doc_id", 0.2, salt=3)
    b_train, b_test = M.split(d.repartition(7), "doc_id", 0.2, salt=3)
    ids = lambda df: sorted(r[0] for r in df.collect())
    assert ids(a_test) == ids(b_test) and ids(a_train) == ids(b_train)
    assert a_train.count() + a_test.count() == d.count()
    assert 0.1 < a_test.count() / d.count() < 0.3
    assert ids(M.split(d, "doc_id", 0.2, salt=4)[1]) != ids(a_test)


def test_binary_metrics_edges(spark):
    none_pos = spark.createDataFrame([(1.0, 0.0, 0.2), (0.0, 0.0, 0.1)], "label double, prediction double, s double")
    m = M.binary_metrics(none_pos, score="s").first()
    assert m["precision"] is None and m["recall"] == 0.0 and m["auc"] == 1.0
    perfect = spark.createDataFrame([(1.0, 1.0, 0.9), (0.0, 0.0, 0.1), (1.0, 1.0, 0.8)],
                                    "label double, prediction double, s double")
    m = M.binary_metrics(perfect, score="s").first()
    assert (m["accuracy"], m["f1"], m["auc"]) == (1.0, 1.0, 1.0)
    assert m["majority_accuracy"] == pytest.approx(2 / 3)
    tied = spark.createDataFrame([(1.0, 1.0, 0.5), (0.0, 1.0, 0.5)], "label double, prediction double, s double")
    assert M.binary_metrics(tied, score="s").first()["auc"] == 0.5
    c = {(r["label"], r["prediction"]): r["count"] for r in M.confusion(perfect).collect()}
    assert c == {(1.0, 1.0): 2, (0.0, 0.0): 1}


def test_compare_models_repeatable(spark):
    data = registry.document_features(spark, "/root/testdata/sf0.01")
    train, test = M.split(data, "doc_id", 0.2, salt=7)
    stages = M.preprocess(registry._NUMERIC_FEATURES, ["lang", "source"])
    ests = {"lr": LogisticRegression(labelCol="label", featuresCol="features", maxIter=20)}
    ests.update({k: v for k, v in M.default_estimators().items() if k == "random_forest"})
    a = M.compare_models(train, test, stages, ests, order_key="doc_id").collect()
    b = M.compare_models(train, test, stages, ests, order_key="doc_id").collect()
    assert [r.asDict() for r in a] == [r.asDict() for r in b]
    assert [r["rank"] for r in a] == [1, 2]
    assert all(0.0 <= r["auc"] <= 1.0 for r in a)


def test_flatten_hourly(spark, scratch):
    p = _lines(os.path.join(scratch, "weather.jsonl"), [
        {"latitude": 37.5, "longitude": 127.0,
         "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00", "bad"],
                    "temperature_2m": [-3.5, None]}},          # null reading, unequal length, bad time
        {"latitude": 35.1, "longitude": 129.0},                # missing hourly
    ])
    every = collect_job.weather_rows(spark, p).collect()
    assert [r["_reason"] for r in every if r["_reason"]] == ["no hourly arrays"]   # kept with its text
    rows = [r for r in every if r["_reason"] is None]
    assert len(rows) == 3
    by_text = {r["time_text"]: r for r in rows}
    assert by_text["2024-01-01T01:00"]["temperature_2m"] is None
    assert by_text["bad"]["time"] is None and by_text["bad"]["temperature_2m"] is None
    assert str(by_text["2024-01-01T00:00"]["time"]) == "2024-01-01 00:00:00"


def test_collect_job_end_to_end(spark, scratch):
    w = _lines(os.path.join(scratch, "weather.jsonl"), [
        {"latitude": 37.5, "longitude": 127.0,
         "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [-3.5, 99.0]}}])
    c = _lines(os.path.join(scratch, "countries.jsonl"), [
        {"code": "KR", "name": "Korea", "population": 51700000},
        {"code": "JP", "name": "Japan", "population": None}])
    ip = _lines(os.path.join(scratch, "ip.jsonl"), [
        {"query": "1.1.1.1", "status": "success", "countryCode": "KR", "lat": 37.5, "lon": 127.0},
        {"query": "2.2.2.2", "status": "fail"},
        {"query": "3.3.3.3", "status": "success", "countryCode": "ZZ", "lat": 0.0, "lon": 0.0}])
    summary = collect_job.run(spark, w, c, ip, os.path.join(scratch, "out"))
    got = {(r["dataset"], r["status"]): r["rows"] for r in summary.collect()}
    assert got == {("weather", "valid"): 1, ("weather", "rejected"): 1, ("countries", "valid"): 2,
                   ("locations", "valid"): 1, ("locations", "rejected"): 2}
    loc = spark.read.parquet(os.path.join(scratch, "out", "locations")).where("status = 'valid'").first()
    assert loc["country_name"] == "Korea"


ADULT = [
    (39, " State-gov", 77516, " Bachelors", 13, " Never-married", " Adm-clerical", " Not-in-family",
     " White", " Male", 2174, 0, 40, " United-States", " <=50K"),
    (50, " ?", 83311, " Bachelors", 13, " Married", " ?", " Husband", " White", " Male", 0, 0, 13,
     " United-States", " >50K"),
    (38, " Private", 215646, " HS-grad", 9, " Divorced", " Handlers", " Not-in-family", " White",
     " Male", 0, 0, 40, " ?", " <=50K."),
]


def test_analysis_run_on_census_shape(spark, scratch):
    lines = [", ".join("?" if isinstance(v, str) and v.strip() == "?" else str(v).strip() if not isinstance(v, str)
                       else v.strip() for v in row) for row in ADULT * 20]
    path = os.path.join(scratch, "adult.csv")
    with open(path, "w") as fh:
        fh.write("\n".join(f"{i}, {line}" for i, line in enumerate(lines)) + "\n")
    from quarry.sources.files import read_with_null_token
    schema = ("row_id int, age int, workclass string, fnlwgt int, education string, education_num int, "
              "marital_status string, occupation string, relationship string, race string, sex string, "
              "capital_gain int, capital_loss int, hours_per_week int, native_country string, income string")
    df = read_with_null_token(spark, path, schema)
    assert df.where(F.col("workclass").isNull()).count() == 20
    spec = analysis.census_spec([R.required("income"), R.in_range("age", 17, 99)])
    spec.fit_models = False
    rep = analysis.run_analysis(df, spec)
    assert rep.columns == ["section", "item", "metric", "value"]
    sections = {r["section"] for r in rep.select("section").distinct().collect()}
    assert {"validation", "profile", "t_test:age", "chi_square:sex", "outliers:hours_per_week"} <= sections
    lab = df.select(spec.label.alias("l")).groupBy("l").count().collect()
    assert {r["l"]: r["count"] for r in lab} == {0.0: 40, 1.0: 20}      # trailing dot handled


def _counted(spark, monkeypatch=None):
    """A features table whose ``upper_share`` counts its evaluations, and that count."""
    seen = spark.sparkContext.accumulator(0)

    def share(i):
        seen.add(1)
        return (i % 17) / 20

    i = F.col("id")
    df = spark.range(0, 240, 1, 3).select(
        i.alias("doc_id"), (i % 2).cast("double").alias("label"), F.when(i % 11 > 0, F.concat(F.lit("l"), i % 3)).alias("lang"),
        F.concat(F.lit("s"), i % 4).alias("source"), (i * 7 % 101).cast("double").alias("n_chars"), (i % 13).cast("double").alias("n_words"),
        (i % 5).cast("double").alias("n_lines"), F.udf(share, "double")("id").alias("upper_share"),
        (i % 3 / 10).alias("digit_share"), (i % 7 / 10).alias("punct_share"))
    if monkeypatch is not None:
        monkeypatch.setattr(registry, "document_features", lambda *_: df)
    return df, seen


def test_analysis_run_computes_its_input_once(spark):
    df, seen = _counted(spark)
    spec = analysis.AnalysisSpec(
        label=F.col("label"), key="doc_id", numeric=registry._NUMERIC_FEATURES, categorical=["lang", "source"],
        rules=[R.required("lang"), R.in_range("upper_share", 0, 0.7), R.check("has_words", F.col("n_words") > 0)],
        outlier_columns=["n_words"], fit_models=False)
    got = {(r["section"], r["item"], r["metric"]): r["value"] for r in analysis.run_analysis(df, spec).collect()}
    assert seen.value == 240
    lost = [i for i in range(240) if i % 11 == 0 or i % 17 > 14 or i % 13 == 0]
    assert got["validation", "required:lang", "n_failed"] == len(range(0, 240, 11))
    assert got["validation", "in_range:upper_share", "n_failed"] == sum(i % 17 > 14 for i in range(240))
    assert got["validation", "has_words", "n_rows"] == 240
    assert got["profile", "upper_share", "n"] == got["outliers:n_words", "all", "n_rows"] == 240 - len(lost)


@pytest.mark.parametrize("name", ["model_comparison", "fitted_features"])
def test_model_queries_compute_their_features_once(spark, monkeypatch, name):
    _, seen = _counted(spark, monkeypatch)
    monkeypatch.setattr(M, "default_estimators", lambda label="label": {"lr": LogisticRegression(labelCol=label, maxIter=3)})
    registry.QUERIES[name](spark, "unused").collect()
    assert seen.value == 240


def test_document_features_of_odd_texts(spark, scratch):
    texts = ["", None, "ABC", "a\U0001F600B\n9!?.", "\u00c9 \u0661 1", "x" * 70000 + "Q"]
    spark.createDataFrame([(i, t, "en", "s", 0 if t is None else len(t)) for i, t in enumerate(texts)],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(len(texts))], "doc_id long, quality int").write.parquet(f"{scratch}/labels.parquet")
    got = {r["doc_id"]: r for r in registry.document_features(spark, scratch).collect()}
    for i, t in enumerate(texts):
        for c, of in (("upper_share", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit_share", "0123456789"), ("punct_share", "!?.")):
            assert got[i][c] == (None if t is None else sum(x in of for x in t) / max(len(t), 1)), (i, c)


def test_streaming_validation_and_flags(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _lines(os.path.join(src, "part-0.jsonl"), [
        {"id": 1, "name": "a", "age": 30}, {"id": 2, "name": None, "age": 40}, "{broken",
        {"id": 3, "name": "c", "age": 500}])
    s = ST.validated_stream(spark, src, "id int, name string, age int",
                            [R.required("name"), R.in_range("age", 0, 130)])
    q = ST.write_split_stream(s, os.path.join(scratch, "out"), "records_test",
                              checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(120)
    back = spark.read.parquet(os.path.join(scratch, "out"))
    got = {r["status"]: r["count"] for r in back.groupBy("status").count().collect()}
    assert got == {"valid": 1, "rejected": 3}
    assert back.where(F.array_contains("errors", ST.UNPARSEABLE)).count() == 1

    # outlier flags on a stream, bounds from history
    hist = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    bounds = O.iqr_bounds(hist, "value", by=["event_type"])
    ev_dir = os.path.join(scratch, "events")
    hist.limit(200).write.parquet(ev_dir)
    stream = spark.readStream.schema(hist.schema).parquet(ev_dir)
    flagged = ST.flag_stream(stream, bounds, "value", by=["event_type"])
    counts = ST.windowed_outlier_counts(flagged, "ts", "1 day", "1 hour")
    q2 = (counts.writeStream.format("memory").queryName("flag_counts_test").outputMode("update")
          .option("checkpointLocation", os.path.join(scratch, "ck2")).trigger(availableNow=True).start())
    q2.awaitTermination(120)
    tot = spark.sql("SELECT sum(n_rows) AS n FROM flag_counts_test").first()["n"]
    assert tot == 200


def test_update_log_keeps_latest_and_drops_late_rows(spark, scratch):
    import time
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    batches = [
        [("2024-01-10T12:00:00", False), ("2024-01-10T13:00:00", True)],
        [("2024-01-10T14:00:00", False), ("2024-01-12T00:30:00", True)],
        # the watermark is now 2024-01-11T23:30; late rows are filtered by the
        # previous batch's watermark (Spark 3.5+), so this row still counts
        [("2024-01-10T15:00:00", True), ("2024-01-12T02:00:00", False)],
        # the 10th closed before this batch began: dropped
        [("2024-01-10T16:00:00", True), ("2024-01-12T03:00:00", False)],
    ]
    for i, rows in enumerate(batches):
        _lines(os.path.join(src, f"part-{i}.jsonl"), [{"ts": t, "is_outlier": o} for t, o in rows])
        t = time.time() - 100 + i
        os.utime(os.path.join(src, f"part-{i}.jsonl"), (t, t))    # files are taken oldest first
    s = spark.readStream.schema("ts timestamp, is_outlier boolean").option("maxFilesPerTrigger", 1).json(src)
    counts = ST.windowed_outlier_counts(s, "ts", "1 day", "1 hour")
    q = ST.write_update_log(counts, os.path.join(scratch, "out"), "update_log_test",
                            checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(120)
    assert spark.read.parquet(os.path.join(scratch, "out")).select("batch_id").distinct().count() >= 4
    got = {r["window"]["start"].day: (r["n_rows"], r["n_outliers"])
           for r in ST.read_update_log(spark, os.path.join(scratch, "out"), ["window"]).collect()}
    assert got == {10: (4, 2), 12: (3, 1)}


def test_wall_clock_windows_ignore_session_time_zone(spark):
    from quarry import registry
    old = spark.conf.get("spark.sql.session.timeZone")
    got = {}
    try:
        for tz in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got[tz] = sorted(tuple(r) for r in registry.QUERIES["stream_outlier_windows"](
                spark, "/root/testdata/sf0.001").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got["UTC"] == got["America/Los_Angeles"]
    assert all(r[0].hour == 0 and r[0].minute == 0 for r in got["UTC"])
