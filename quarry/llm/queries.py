"""Registered queries of the training-data operators, and their oracles.

Each applies its operator to a whole table with production parameters. SQL is
given where it can express the operator; the others are tested against
brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.best_position import ranked_search
from quarry.llm.credentials import credential_counts
from quarry.llm.cross_polytope import nearest_neighbours
from quarry.llm.decontamination import contamination
from quarry.llm.divergence import source_divergence
from quarry.llm.exact_dedup import exact_dedup
from quarry.llm.jaccard_join import jaccard_join
from quarry.llm.licenses import license_scan
from quarry.llm.main_text import extract_main_text
from quarry.llm.packing import pack_documents
from quarry.llm.personal_data import personal_counts
from quarry.llm.quality import document_statistics, fit_quality, score_quality
from quarry.llm.textops import bounded_batches
from quarry.llm.toxicity import fit_toxicity, score_toxicity
from quarry.session import ensure_checkpoint_dir

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    stats = document_statistics(_read(spark, sf_dir, "documents")).checkpoint()
    return score_quality(stats, fit_quality(stats, _read(spark, sf_dir, "labels")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_read(spark, sf_dir, "documents"))


def op3_toxicity_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, _read(spark, sf_dir, "labels")))


def op4_credential_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credential_counts(_read(spark, sf_dir, "documents"))


def op5_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(_read(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_counts(_read(spark, sf_dir, "documents"))


def op7_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_read(spark, sf_dir, "pages"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_read(spark, sf_dir, "documents"))


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_read(spark, sf_dir, "documents"), tokenizer_path())


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_read(spark, sf_dir, "documents"))


def op12_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_read(spark, sf_dir, "embeddings"))


def op13_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_quality_qda, op2_exact_dedup, op3_toxicity_bigru, op4_credential_linking, op5_chosen_path_join,
    op6_personal_data, op7_host_suffix_array, op8_license_scan, op9_vector_packing, op10_decontamination,
    op11_source_divergence, op12_cross_polytope, op13_best_position)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE: dict[str, str] = {
    "op2_exact_dedup": f"""
        WITH n AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY norm)""",
    "op10_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
        iw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k + 1:k + least(len(w), 10)], ' ') AS s
               FROM (SELECT item, w, unnest(range(greatest(len(w) - 9, 1))) AS k FROM i WHERE len(w) > 0)),
        dw AS (SELECT doc_id, n, k, array_to_string(w[k + 1:k + n], ' ') AS s
               FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS k
                     FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
        f AS (SELECT doc_id, item, k, n FROM dw JOIN iw USING (n, s)),
        h AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + n)) FROM f) GROUP BY doc_id),
        x AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, item FROM f) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN h USING (doc_id) LEFT JOIN x USING (doc_id)""",
    "op11_source_divergence": f"""
        WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          {_LETTERS} AS w FROM documents),
        t AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
        v AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT doc) >= 30),
        c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN v USING (lang, term) GROUP BY ALL),
        g AS (SELECT DISTINCT lang, source FROM d),
        size AS (SELECT lang, count(*) AS v, sum(n) AS total FROM v GROUP BY lang),
        total AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
        cell AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
                        1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5) // (coalesce(total.total, 0) + 5 * size.v) AS p,
                        1 + CAST(1000000000 AS HUGEINT) * (v.n + 5) // (size.total + 5 * size.v) AS q
                 FROM g JOIN size USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term
                 LEFT JOIN total ON total.lang = g.lang AND total.source = g.source),
        s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
              FROM cell a JOIN cell b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM cell WHERE n > 0 AND p > q),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
                   FROM parts)
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50""",
    "op13_best_position": f"""
        WITH d AS (SELECT row_number() OVER () AS doc, doc_id, {_WORDS} AS w FROM documents),
        size AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
        i AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark),
        t AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(w) AS term FROM d)
              WHERE term IN (SELECT term FROM i) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * max(size.n) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
              FROM t, size GROUP BY term),
        x AS (SELECT doc, doc_id, 100 - 90 + (90 * len(w) * size.n) // size.l AS m FROM d, size WHERE len(w) > 0),
        s AS (SELECT i.item_id, x.doc, x.doc_id, CAST(sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * x.m))) AS BIGINT) AS score
              FROM i JOIN t USING (term) JOIN w USING (term) JOIN x ON x.doc = t.doc GROUP BY ALL),
        r AS (SELECT item_id, doc_id, score,
                     CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
              FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""",
}
