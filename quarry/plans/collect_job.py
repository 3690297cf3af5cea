"""The collection job: landed payloads -> flattened, validated, enriched -> files.

Sources are the files an API client landed (one JSON document per line):
hourly weather per location, country facts, and IP-location answers. The job
reads them under declared schemas, flattens the hourly arrays, validates
rows, attaches country attributes and writes valid and rejected rows of each
dataset (damaged documents included) in one pass (``status=valid`` / ``status=rejected`` folders).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators.ingest import enrich, flatten_hourly
from ..operators.validate import write_split
from ..sources.files import read_payloads

# Declared schemas of the landed payloads.
WEATHER_SCHEMA = ("latitude double, longitude double, "
                  "hourly struct<time: array<string>, temperature_2m: array<double>>")
COUNTRY_SCHEMA = "code string, name string, population bigint"
IPLOCATION_SCHEMA = "query string, status string, countryCode string, lat double, lon double"


#: Why a document became a rejected row of its own; null for a row of a sound document.
REASON = "_reason"
UNPARSED, NO_HOURLY = "unparsed", "no hourly arrays"


def document_rule() -> R.Rule:
    return R.check("sound_document", F.col(REASON).isNull())


def weather_rules():
    return [document_rule(), R.required("time"), R.required("temperature_2m"),
            R.in_range("temperature_2m", -90.0, 60.0),
            R.in_range("latitude", -90.0, 90.0), R.in_range("longitude", -180.0, 180.0)]


def country_rules():
    return [document_rule(), R.required("code"), R.required("name")]


def location_rules():
    return [document_rule(), R.one_of("status", ["success"]), R.required("countryCode"),
            R.matches("countryCode", r"^[A-Z]{2}$"), R.required("country_name")]


def _marked(docs: DataFrame, reason: Column) -> DataFrame:
    """``_reason`` per document; a sound document's text is not carried along."""
    return docs.withColumn(REASON, reason).withColumn("_raw", F.when(F.col(REASON).isNotNull(), F.col("_raw")))


def weather_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row per hourly step, and one row with text and reason per damaged document."""
    docs = read_payloads(spark, path, WEATHER_SCHEMA)
    empty = F.coalesce(F.size("hourly.time"), F.lit(0)).__le__(0) & F.coalesce(F.size("hourly.temperature_2m"), F.lit(0)).__le__(0)
    docs = _marked(docs, F.when(~F.col("_parsed"), F.lit(UNPARSED)).when(empty, F.lit(NO_HOURLY)))
    keep = ["latitude", "longitude", "_file", "_raw", REASON]
    steps = flatten_hourly(docs.where(F.col(REASON).isNull()), "hourly.time", ["hourly.temperature_2m"], keep=keep)
    damaged = docs.where(F.col(REASON).isNotNull()).select(*keep)
    return steps.unionByName(damaged, allowMissingColumns=True)


def country_rows(spark: SparkSession, path: str) -> DataFrame:
    docs = read_payloads(spark, path, COUNTRY_SCHEMA)
    return _marked(docs, F.when(~F.col("_parsed"), F.lit(UNPARSED))).drop("_parsed")


def location_rows(spark: SparkSession, ip_path: str, country_path: str) -> DataFrame:
    """One row per IP answer; a damaged one keeps its text and reason."""
    docs = read_payloads(spark, ip_path, IPLOCATION_SCHEMA)
    ip = _marked(docs, F.when(~F.col("_parsed"), F.lit(UNPARSED))).drop("_parsed")
    countries = country_rows(spark, country_path).where(F.col(REASON).isNull()).select(
        F.col("code").alias("countryCode"), F.col("name").alias("country_name"), "population")
    return enrich(ip, countries, ["countryCode"], how="left")


def run(spark: SparkSession, weather_path: str, country_path: str, ip_path: str,
        out_dir: str, mode: str = "errorifexists") -> DataFrame:
    """Write all three datasets; return ``dataset, status, rows`` read back from the output.

    Every input document is in the output: as its rows, or as one rejected row
    with its text (``_raw``) and reason.
    """
    out = out_dir.rstrip("/")
    write_split(weather_rows(spark, weather_path), weather_rules(), f"{out}/weather", mode=mode)
    write_split(country_rows(spark, country_path), country_rules(), f"{out}/countries", mode=mode)
    write_split(location_rows(spark, ip_path, country_path), location_rules(),
                f"{out}/locations", mode=mode)
    parts = [spark.read.parquet(f"{out}/{name}").groupBy("status").count()
             .select(F.lit(name).alias("dataset"), "status", F.col("count").alias("rows"))
             for name in ("weather", "countries", "locations")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
