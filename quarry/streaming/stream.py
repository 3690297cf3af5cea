"""The validation rules and outlier flags on Structured Streaming.

Rules are stateless Column expressions, so the same list that checks a table
checks a file stream. Outlier bounds come from history (a static table) and are
applied to new rows by a stream-static join; late data is handled by the
watermark of the windowed counts.

Checkpoints go under the session's ``spark.checkpoint.dir`` unless a location
is given: a shared folder on a cluster, so a restarted query resumes exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.rules import Rule
from ..operators.joins import join_small
from ..operators.quantiles import clean_value
from ..operators.validate import ERRORS, errors_column
from ..sources.files import CORRUPT, _schema

UNPARSEABLE = "unparseable"


def _wall_epoch():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def validated_stream(spark: SparkSession, path: str, schema: str, rules: Sequence[Rule],
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files arriving in ``path`` -> typed rows with ``errors``.

    A line that does not parse (or does not fit the schema) gets the error
    ``unparseable`` and keeps its text in ``_raw``.
    """
    sch = _schema(schema)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sch.fields)
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(path).where(F.trim("value") != "")
    parsed = lines.select(F.col("value").alias("_raw"), F.from_json(
        "value", f"{ddl}, `{CORRUPT}` string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("__r"))
    rows = parsed.select("_raw", "__r.*")
    bad_parse = F.col(CORRUPT).isNotNull()
    errs = F.when(bad_parse, F.array(F.lit(UNPARSEABLE))).otherwise(errors_column(list(rules)))
    return rows.withColumn(ERRORS, errs).drop(CORRUPT)


def _checkpoint(spark: SparkSession, name: str, location: str | None) -> str:
    if location:
        return location
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("no checkpoint location: set spark.checkpoint.dir or pass one")
    return f"{base.rstrip('/')}/streams/{name}"


def write_split_stream(stream: DataFrame, out_path: str, name: str,
                       checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Append valid and rejected rows under ``status=`` folders (exactly once)."""
    spark = stream.sparkSession
    out = stream.withColumn(
        "status", F.when(F.size(ERRORS) == 0, F.lit("valid")).otherwise(F.lit("rejected")))
    w = (out.writeStream.format("parquet").outputMode("append").partitionBy("status")
         .option("checkpointLocation", _checkpoint(spark, name, checkpoint)).queryName(name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start(out_path)


def flag_stream(stream: DataFrame, bounds: DataFrame, col: str,
                by: Sequence[str] | None = None) -> DataFrame:
    """Add ``is_outlier`` to streaming rows using bounds computed on history.

    ``bounds`` is the output of ``iqr_bounds`` on a static table; grouped, it
    is joined stream-static on the group keys (broadcast when small).
    """
    by = list(by or [])
    if not by:
        row = bounds.select("lower", "upper").first()
        lo, hi = (row["lower"], row["upper"]) if row else (None, None)
        j = stream.withColumn("__lower", F.lit(lo).cast("double")).withColumn(
            "__upper", F.lit(hi).cast("double"))
    else:
        side = bounds.select(*by, F.col("lower").alias("__lower"), F.col("upper").alias("__upper"))
        j = join_small(stream, side, by, how="left")
    flag = ~clean_value(col).between(F.col("__lower"), F.col("__upper"))
    return j.withColumn("is_outlier", flag).drop("__lower", "__upper")


def windowed_outlier_counts(flagged: DataFrame, ts: str, window: str = "1 hour",
                            watermark: str = "10 minutes",
                            by: Sequence[str] | None = None) -> DataFrame:
    """``window, by..., n_rows, n_outliers`` per event-time window.

    A window's state is dropped once the watermark passes its end; a row for a
    window that had closed before the current micro-batch began (the previous
    batch's watermark, as Spark 3.5+ filters late rows) is dropped. In append
    mode finished windows are emitted once; ``write_update_log`` shows them as
    they change."""
    by = list(by or [])
    wall = flagged.schema[ts].dataType.typeName() == "timestamp_ntz"
    if wall:
        # Watermarks need an instant. A wall-clock time is read as that time in
        # UTC (microseconds since the wall-clock epoch), whatever the session
        # time zone, so windows follow wall-clock days and come back unchanged.
        flagged = flagged.withColumn(ts, F.timestamp_micros(
            F.timestamp_diff("MICROSECOND", _wall_epoch(), F.col(ts))))
    out = (flagged.withWatermark(ts, watermark)
           .groupBy(F.window(ts, window), *by)
           .agg(F.count(F.lit(1)).alias("n_rows"),
                F.count_if(F.col("is_outlier")).alias("n_outliers")))
    if wall:
        back = lambda c: F.timestamp_add("MICROSECOND", F.unix_micros(c), _wall_epoch())
        out = out.withColumn("window", F.struct(back(F.col("window.start")).alias("start"),
                                                back(F.col("window.end")).alias("end")))
    return out


def write_update_log(agg: DataFrame, out_path: str, name: str,
                     checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Run a streaming aggregate in update mode; each micro-batch's changed
    rows go to ``out_path/batch_id=N``.

    File sinks only take append mode, which holds a window back until the
    watermark passes its end; the update log shows every window as soon as it
    changes. A retried batch overwrites its own folder, so the log is exactly
    once; ``read_update_log`` gives the current value per key.
    """
    spark = agg.sparkSession

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    w = (agg.writeStream.outputMode("update").foreachBatch(write_batch)
         .option("checkpointLocation", _checkpoint(spark, name, checkpoint)).queryName(name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_update_log(spark: SparkSession, out_path: str, keys: Sequence[str]) -> DataFrame:
    """Latest row per key from an update log (one partial aggregate)."""
    log = spark.read.parquet(out_path)
    rest = [c for c in log.columns if c not in keys and c != "batch_id"]
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("__v"))
    return latest.select(*keys, "__v.*")
