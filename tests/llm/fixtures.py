"""Small document tables with the awkward cases every operator must take."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use inside; a table may well have such columns too.
CLASHING = ["_t", "_sha", "_id", "_row", "_key", "path", "rep", "n", "sig", "kept", "score", "keep_id", "found", "parts", "text_sha256"]


def lower_ascii(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(lower_ascii(text))


def invented(rng: random.Random, n: int) -> str:
    parts = ["tra", "lon", "mi", "ste", "kor", "été", "ßu", "an", "the", "or"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


def table(spark: SparkSession, texts: list[str | None], ids: list | None = None, clash: bool = False) -> DataFrame:
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, None if k % 3 else "en", f"src{k % 4}", None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    if clash:
        for name in CLASHING:
            docs = docs.withColumn(name, docs["source"])
    return docs


AWKWARD = [None, "", " ", "\n\n", "a", "A", "one two three", "É é Ünï", "x" * 70_000, "word " * 20_000, "1 2 " * 5_000,
           "token = ", "@@@@", "+1", "\x00\x01", "日本語 テキスト", "<p>not html", "same same same", "same same same", "SAME same Same"]
