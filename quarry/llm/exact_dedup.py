"""Exact deduplication by skew-safe combining.

Texts are equal when identical after lower-casing A-Z only (null counts as
empty). Three combining steps, each comparing the full normalised text:

1. local: the map-side half of the salted aggregate keeps one row per distinct
   text and salt in every task, so a hot text leaves a task at most ``salts`` times;
2. salted merge: groups of (digest, salt, text) meet in ``salts`` separate tasks
   per digest;
3. global: the salt winners of a (digest, text) meet, at most ``salts`` of them.

Equal digests with different texts stay different groups, because the text is
part of every grouping key. A row then finds its group by three independent
fingerprints of its text (SHA-256, MD5, length), so the text itself is not
moved a third time; that join is salted too and only holds groups of two or more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null becomes empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # lower() is much cheaper than translate() and the same on pure ASCII.
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def _marks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = docs.select(F.col(f"`{id_col}`").alias("_id"), lower_ascii(F.col(f"`{text_col}`")).alias("_norm"))
    return norm.select("_id", "_norm", F.sha2("_norm", 256).alias("_sha"), F.md5("_norm").alias("_md5"),
                       F.char_length("_norm").alias("_len"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 8) -> DataFrame:
    """One row per distinct text: ``_sha, _md5, _len, keep_id, group_size``.

    ``keep_id`` is the largest id (null only if no row of the text has an id).
    """
    marks = _marks(docs, id_col, text_col).withColumn("_salt", F.pmod(F.hash("_id"), F.lit(salts)))
    key = ["_sha", "_md5", "_len", "_norm"]
    salted = marks.groupBy(*key, "_salt").agg(F.max("_id").alias("_id"), F.count("*").alias("_n"))
    return salted.groupBy(*key).agg(F.max("_id").alias("keep_id"), F.sum("_n").alias("group_size")).drop("_norm")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 8) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the largest id stays. Of rows repeating both the
    id and the text, all are reported with the same ``kept``. A null id is never
    preferred; where all ids of a text are null, ``keep_id`` is null and its rows
    are kept. Other columns of ``docs`` are ignored.
    """
    rows = _marks(docs, id_col, text_col).drop("_norm").withColumn("_salt", F.pmod(F.hash("_id"), F.lit(salts)))
    several = exact_groups(docs, id_col, text_col, salts).where("group_size > 1").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    found = rows.join(several, ["_sha", "_md5", "_len", "_salt"], "left")
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("_id")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("_id").alias("doc_id"), keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"), F.col("_sha").alias("text_sha256"))


def keep_exact(docs: DataFrame, salts: int = 8) -> DataFrame:
    """The rows of ``docs`` that stay, whole, one per distinct text.

    Rows repeating both id and text are merged into one of them.
    """
    def key(doc_id: Column, sha: Column) -> Column:
        return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), sha)

    stay = exact_groups(docs, salts=salts).select(key(F.col("keep_id"), F.col("_sha")).alias("_key"))
    rows = docs.select(key(F.col("doc_id"), F.sha2(lower_ascii(F.col("text")), 256)).alias("_key"),
                       F.struct("*").alias("_row"))
    return rows.join(stay, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")
