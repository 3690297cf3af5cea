"""Reading and writing files under a declared schema.

Schemas are always declared, never inferred: a file that drifts shows up as
rejected rows, not as a silently different table. Unparseable records are
kept aside with their raw text instead of failing the job
(``read_with_quarantine``), which is the distributed form of catching a
parse exception per record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _schema(schema: T.StructType | str | None) -> T.StructType | None:
    if schema is None or isinstance(schema, T.StructType):
        return schema
    return T._parse_datatype_string(schema)  # "a int, b string" DDL


def read_table(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet",
               schema: T.StructType | str | None = None, **options) -> DataFrame:
    """``spark.read`` with a declared schema (required for csv and json)."""
    sch = _schema(schema)
    if sch is None and fmt in ("csv", "json"):
        raise ValueError(f"{fmt} needs a declared schema")
    reader = spark.read.format(fmt)
    if sch is not None:
        reader = reader.schema(sch)
    if fmt == "csv":
        options.setdefault("header", True)
    reader = reader.options(**{k: str(v) if isinstance(v, bool) else v for k, v in options.items()})
    paths = [path] if isinstance(path, str) else list(path)
    return reader.load(paths if len(paths) > 1 else paths[0])


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] | None = None, mode: str = "errorifexists",
                **options) -> None:
    """``df.write`` in one pass; ``partition_by`` lays out one folder per value."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        options.setdefault("header", True)
    w.options(**{k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}).save(path)


def read_with_quarantine(spark: SparkSession, path: str | Sequence[str],
                         schema: T.StructType | str, fmt: str = "json",
                         delimiter: str = ",", header: bool = True,
                         **options) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: parsed rows, and the raw lines that did not parse.

    A record is bad when it is not valid, a field does not fit its declared
    type, or (csv) it has too few or too many fields. ``bad`` has ``_raw`` and
    ``_file``. JSON lines are read as text and parsed with ``from_json``; CSV goes
    through Spark's reader, and a file whose header differs from the schema's names
    fails the job instead of passing for data. CSV records must not span lines.
    """
    sch = _schema(schema)
    with_corrupt = T.StructType(list(sch.fields) + [T.StructField(CORRUPT, T.StringType())])
    paths = [path] if isinstance(path, str) else list(path)
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **options}
    if fmt == "json":
        lines = (spark.read.text(paths)
                 .select(F.col("value").alias("_raw"), F.col("_metadata.file_path").alias("_file"))
                 .where(F.trim("_raw") != ""))
        parsed = lines.select("_raw", "_file", F.from_json("_raw", with_corrupt, opts).alias("__r"))
        bad_flag = F.col(f"__r.{CORRUPT}").isNotNull() | F.col("__r").isNull()
        good = parsed.where(~bad_flag).select(*[F.col(f"__r.`{f.name}`").alias(f.name) for f in sch.fields])
        return good, parsed.where(bad_flag).select("_raw", "_file")
    if fmt == "csv":
        # Spark's reader takes the header line of each file and checks its names
        # against the schema; a data line that equals the header is data.
        rows = (spark.read.schema(with_corrupt).options(**{**opts, "sep": delimiter, "header": header, "enforceSchema": False})
                .csv(paths))
        names = [F.col(f"`{f.name}`") for f in sch.fields]
        # Spark prunes fields that are not asked for and then does not see that
        # they are damaged: this always-true condition asks for all of them.
        every = F.concat_ws("", *[c.cast("string") for c in names]) >= ""
        rows = rows.where(every)
        good = rows.where(F.col(CORRUPT).isNull()).select(*names)
        bad = rows.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("_raw"), F.col("_metadata.file_path").alias("_file"))
        return good, bad
    raise ValueError("quarantine reads json or csv")


def read_payloads(spark: SparkSession, path: str | Sequence[str],
                  schema: T.StructType | str) -> DataFrame:
    """Landed API responses, one JSON document per line, parsed to ``schema``.

    Adds ``_file`` (where it landed), ``_parsed`` (false when the document did not
    parse or a value does not fit its type) and ``_raw`` (the document's text).
    """
    sch = _schema(schema)
    with_corrupt = T.StructType(list(sch.fields) + [T.StructField(CORRUPT, T.StringType())])
    paths = [path] if isinstance(path, str) else list(path)
    raw = (spark.read.text(paths).where(F.trim("value") != "")
           .select(F.col("value").alias("_raw"), F.from_json("value", with_corrupt,
                               {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("__r"),
                   F.col("_metadata.file_path").alias("_file")))
    return raw.select(*[F.col(f"__r.`{f.name}`").alias(f.name) for f in sch.fields], "_file",
                      F.col(f"__r.{CORRUPT}").isNull().alias("_parsed"), "_raw")


def read_with_null_token(spark: SparkSession, path: str | Sequence[str],
                         schema: T.StructType | str, token: str = "?",
                         header: bool = False, **options) -> DataFrame:
    """CSV where a token (``?`` in census-style files) marks a missing value.

    Leading and trailing blanks around fields are dropped, so `` ?`` is null too.
    """
    return read_table(spark, path, "csv", schema, header=header, nullValue=token,
                      ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, **options)
