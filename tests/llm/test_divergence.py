"""Source divergence audit against a plain version with Python integers."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
from tests.llm.fixtures import AWKWARD, DOC_SCHEMA, invented, table

from quarry.llm.divergence import proportions, run_differences, source_divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least_docs=30, top=50):
    counts, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        found = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        groups[lang].add(source)
        counts[lang, source].update(found)
        df[lang].update(set(found))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= least_docs]
        v = len(kept)
        whole = sum((counts[lang, s] for s in sources), Counter())

        def p(count, kept=kept, v=v):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * v) for t in kept}

        of = {s: p(counts[lang, s]) for s in sources}
        q = p(whole)
        for s in sources:
            pairs = [(o, sum(abs(of[s][t] - of[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, of[s][t] - q[t]) for t in kept if counts[lang, s][t] > 0 and of[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:limit])}
    return out


def rows_of(df):
    got = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_equals_plain_version_with_many_sources_tiles_and_blocks(spark):
    rng = random.Random(5)
    rows = []
    for k in range(900):
        lang = rng.choice(["en", "en", "fr", None, ""])
        source = "hot" if rng.random() < 0.4 else f"s{rng.randint(0, 11)}"
        rows.append((invented(rng, rng.randint(0, 60)), lang, source if rng.random() < 0.97 else None))
    docs = spark.createDataFrame([(k, t, la, s, 0) for k, (t, la, s) in enumerate(rows)], DOC_SCHEMA)
    want = brute(rows)
    assert rows_of(source_divergence(docs)) == want
    # Tiles of sources, blocks of rows and partitions do not change the result.
    assert rows_of(source_divergence(docs.repartition(7), block_rows=16, tile=3)) == want
    assert rows_of(source_divergence(docs, least_docs=2, top=4, block_rows=50, tile=5)) == brute(rows, 2, 4)


def test_awkward_texts_repeats_and_clashing_names(spark):
    rng = random.Random(6)
    texts = AWKWARD * 2 + ["Same WORDS same words"] * 40 + [invented(rng, 20) for _ in range(30)]
    docs = table(spark, texts, ids=[1] * len(texts), clash=True)
    for name in ("term", "at", "cells", "item", "value", "rank", "part", "df", "total", "v"):
        docs = docs.withColumn(name, docs["source"])
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    assert rows_of(source_divergence(docs, least_docs=5)) == brute(rows, 5)


def test_no_kept_terms_gives_pairs_of_zero_and_empty_table_none(spark):
    docs = table(spark, [None, "", "one two", "1 2 3"])
    got = rows_of(source_divergence(docs))
    assert got == brute([(r["text"], r["lang"], r["source"]) for r in docs.collect()])
    assert got and {r[4] for r in got} == {0}
    assert source_divergence(docs.limit(0)).collect() == []


def test_long_division_is_exact():
    rng = random.Random(7)
    for _ in range(3000):
        bottom = rng.choice([rng.randint(6, 50), rng.randint(6, 10**15)])
        count = rng.randint(0, bottom - 5)
        assert proportions(np.array([count]), np.array([bottom]))[0] == 1 + 10**9 * (count + 5) // bottom


def test_intersected_runs_equal_term_by_term_sums():
    rng = np.random.default_rng(8)
    counts = np.sort(rng.integers(0, 4, (200, 5)), axis=0)
    length = rng.integers(1, 9, 200)
    bottom = (counts * length[:, None]).sum(axis=0) + 5 * length.sum()
    p = np.stack([proportions(counts[:, c], bottom[c]) for c in range(5)], axis=1)
    every = np.arange(5)
    got = {(a, b): v for a, b, v in run_differences(counts, length, bottom, every, every)}
    assert got == {(a, b): int((abs(p[:, a] - p[:, b]) * length).sum()) for a in range(5) for b in range(a + 1, 5)}
