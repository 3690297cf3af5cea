"""The corpus pipeline as a whole, and the registered queries as they are registered."""

from __future__ import annotations

import random
from collections import defaultdict

import duckdb
import pytest

import corpus_pipeline
from quarry.llm import queries
from quarry.llm.quality import document_statistics, fit_quality, score_quality
from tests.conftest import SF_SMOKE
from tests.llm.fixtures import AWKWARD, DOC_SCHEMA, invented, lower_ascii
from tests.llm.test_decontamination import brute as brute_hits
from tests.llm.test_jaccard_join import brute as brute_near


def write(spark, folder, rows, labels, items):
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    for name in ("rep", "path", "score", "_row", "th", "node", "shard"):
        docs = docs.withColumn(name, docs["source"])
    docs.repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_run_equals_plain_stages(spark, scratch):
    rng = random.Random(3)
    passage = invented(rng, 14)
    base = invented(rng, 60)
    texts = [t for t in AWKWARD if t is None or len(t) < 3000]
    texts += [invented(rng, rng.randint(20, 80)) for _ in range(80)]
    texts += [base + " " + invented(rng, 1) for _ in range(12)] + [base.upper()] * 5 + [base] * 3
    texts += [invented(rng, 20) + " " + passage + " " + invented(rng, 20) for _ in range(4)]
    texts += ["#$%& 1234 !!!! ####  0000 $$$$ " * rng.randint(2, 9) for _ in range(30)]
    rows = [(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    rows += [(3, texts[30], None, None, None), (None, texts[31] + " more words here", None, None, None)]
    labels = [(k, int("####" not in (t or "####")), 0) for k, t in enumerate(texts)]
    docs = write(spark, scratch, rows, labels, [(1, passage), (2, None)])

    stats = document_statistics(docs).checkpoint()
    model = fit_quality(stats, spark.read.parquet(f"{scratch}/labels.parquet"))
    good = {(r["doc_id"], r["text"]) for r in docs.join(score_quality(stats, model).where("predicted = 1").select("doc_id").distinct(), "doc_id", "left_semi").collect()}
    first = list(dict.fromkeys((k, t) for k, t, *_ in rows if k is not None and (k, t) in good))
    kept, at = defaultdict(list), {}
    for k, t in first:
        kept[lower_ascii(t)].append((k, t))
    exact = [max(v) for v in kept.values()]

    got = corpus_pipeline.run(spark, scratch)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(got.columns)
    pieces = defaultdict(list)
    for r in got.collect():
        pieces[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"]))
    unique = [(k, t) for k, t in exact if k != 3]
    near = brute_near([t for _, t in unique])
    ids = [k for k, _ in unique]
    least = defaultdict(list)
    for i, (c, *_) in near.items():
        least[c].append(ids[i])
    clean = brute_hits([t for _, t in unique], [(1, passage)])
    hit = {k for k, c in zip(ids, clean, strict=True) if c[4]}
    want = {min(v) for v in least.values()} - hit
    assert want <= set(pieces) and set(pieces) - want <= {3, None}
    for own in pieces.values():
        at = 0
        for start, length, tokens in sorted(own)[:1]:
            assert start == 0
        assert sum(n for _, n, _ in own) % own[0][2] == 0


def test_stages_on_empty_tables(spark, scratch):
    docs = write(spark, scratch, [(1, "x", None, None, None)], [(1, 1, 0)], [(1, "a b")]).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, scratch)
        assert out.count() == 0
        if name != "packing":
            assert out.columns == docs.columns


ROWS = {"op7_host_suffix_array": "pages"}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_registered_query(spark, name):
    """Every query as registered, over whole tables, against its SQL or at least row for row."""
    got = queries.QUERIES[name](spark, SF_SMOKE)
    rows = got.collect()
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMOKE}/{t}.parquet'")
    if name in queries.ORACLE:
        cursor = con.execute(queries.ORACLE[name])
        columns = [d[0] for d in cursor.description]
        want = sorted(map(str, cursor.fetchall()))
        assert sorted(str(tuple(r[c] for c in columns)) for r in rows) == want
    elif name == "op12_cross_polytope":
        asked = con.execute("SELECT count(*) FROM embeddings WHERE vec_id % 100 = 0").fetchall()[0][0]
        assert len(rows) == 10 * asked
    else:
        n = con.execute(f"SELECT count(*) FROM {ROWS.get(name, 'documents')}").fetchall()[0][0]
        assert len(rows) == n or (name == "op9_vector_packing" and len({r["doc_id"] for r in rows}) == n)
