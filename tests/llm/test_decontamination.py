import hashlib
import random

import numpy as np

from quarry.llm.decontamination import _prefixes, contamination, keep_clean, overlap
from tests.llm.fixtures import AWKWARD, invented, table, words


def brute(texts, items, window=10):
    held = {}
    for item, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            if item is not None:
                held.setdefault(tuple(w[k:k + n]), set()).add(str(item))
    out = []
    for t in texts:
        w = words(t)
        hit, found = set(), set()
        for n in {len(k) for k in held}:
            for k in range(len(w) - n + 1):
                own = held.get(tuple(w[k:k + n]))
                if own:
                    hit.update(range(k, k + n))
                    found |= own
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def corpus():
    rng = random.Random(8)
    items = [(k, invented(rng, rng.choice([1, 2, 3, 9, 10, 11, 30]))) for k in range(2, 25)]
    items += [(40, items[5][1]), (41, None), (42, ""), (None, invented(rng, 12)), (43, "the " * 30), (2, "a second text of item two")]
    texts = list(AWKWARD)
    for _ in range(200):
        t = invented(rng, rng.randint(0, 60)).split()
        for _ in range(rng.randint(0, 3)):
            w = words(rng.choice(items)[1])
            a = rng.randint(0, len(w))
            t[len(t) // 2:len(t) // 2] = [x.upper() + "!" for x in w[a:a + rng.randint(1, 20)]]
        texts.append(" ".join(t))
    return texts, items


def test_both_joins_against_brute_force(spark):
    texts, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = table(spark, texts, clash=True).repartition(3)
    want = brute(texts, items)
    for most in (200_000, 0):
        got = {r["doc_id"]: tuple(r)[1:] for r in contamination(docs, bench, max_broadcast_words=most).collect()}
        assert [got[k] for k in range(len(texts))] == want
        kept = keep_clean(docs, bench, max_broadcast_words=most)
        assert kept.columns == docs.columns
        assert {r["doc_id"] for r in kept.collect()} == {k for k, w in enumerate(want) if not w[4]}


def test_repeated_rows_and_null_ids(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    rows = overlap(table(spark, ["x one two three four five six seven eight nine ten y"] * 2 + [None], [7, 7, None]), bench).collect()
    assert sorted((str(r["doc_id"]), r["n_hit"], r["items"]) for r in rows) == [("7", 10, ["1"]), ("7", 10, ["1"]), ("None", 0, [])]


def test_empty_tables(spark):
    docs = table(spark, ["a b c"])
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[1:3] for r in contamination(docs, bench).collect()] == [(3, 0)]
    assert contamination(docs.limit(0), bench).count() == 0
    assert keep_clean(docs, bench).count() == 1


def test_rows_are_kept_by_their_text(spark):
    """A null or shared id neither saves a contaminated row nor drops a clean one."""
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    bad, good = "x one two three four five six seven eight nine ten y", "one two three and nothing more"
    docs = table(spark, [bad, good, bad, good, None], [7, 7, None, None, None])
    for most in (200_000, 0):
        got = keep_clean(docs, bench, max_broadcast_words=most).collect()
        assert sorted(str((r["doc_id"], r["text"])) for r in got) == sorted(map(str, [(7, good), (None, good), (None, None)]))


def test_prefix_is_the_rarest_shingle(spark):
    windows = spark.createDataFrame([("a b c d", 4, [10, 20]), ("e f g", 3, [30])], "phrase string, size long, shingles array<long>")
    counts = spark.createDataFrame([(10, 5), (20, 2)], "h long, n long")
    assert [tuple(r) for r in _prefixes(windows, counts).collect()] == [(20, 1, "a b c d", 4)]


def test_equal_hashes_of_other_words_are_no_hit(spark, monkeypatch):
    """With a word hash that only knows lengths, other words of the same lengths are not the passage."""
    import quarry.llm.decontamination as dec

    real = dec.placed_words

    def weak(data, offsets):
        hashes, before, begin, end = real(data, offsets)
        return (end - begin).astype(np.uint64), before, begin, end

    monkeypatch.setattr(dec, "placed_words", weak)
    items = [("7", "one two three four five six seven eight nine ten"), ("8", "two one three four five six seven eight nine ten")]
    held = dec.Windows([(i, *(lambda h, s: (h, s.words(0, len(h))))(*dec._spelt(t))) for i, t in items], 10)
    held.choose(np.zeros(len(held.distinct), np.int64))
    assert len(held.phrases) == 2  # equal hashes, two windows
    for text, want in (("x One two three four five six seven eight nine ten", [["7"]]), ("x uno dos three four five six seven eight nine ten", []),
                       ("x two one three four five six seven eight nine ten", [["8"]])):
        hashes, spelt = dec._spelt(text)
        _, which = held.occurrences(hashes, np.zeros(len(hashes), np.int64), np.array([0, len(hashes)]), spelt)
        assert [[held.ids[i] for i in held.items[w]] for w in which] == want
