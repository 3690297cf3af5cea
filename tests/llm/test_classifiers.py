import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import toxicity as tox
from quarry.llm.quality import FEATURES, Discriminant, document_statistics, fit_quality, held_out, keep_good, score_quality, statistics
from tests.llm.fixtures import AWKWARD, invented, table

SF = "/root/testdata/sf0.1"


def auc(score, y):
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(len(score))
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(y) - n1))


def held_out_rows(scored, labels, label):
    rows = scored.join(labels, "doc_id").where("held_out").select("score", "predicted", label).collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])


def test_held_out_rule(spark):
    docs = table(spark, ["x"] * 50)
    got = {r["doc_id"]: r["h"] for r in docs.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)}


def test_density_matches_the_formula():
    rng = np.random.default_rng(1)
    x = [rng.standard_normal((300, 3)) @ rng.standard_normal((3, 3)) + k for k in (0, 1)]
    count = np.array([300.0, 300.0])
    total, outer = np.stack([v.sum(axis=0) for v in x]), np.stack([v.T @ v for v in x])
    model = Discriminant.fit(count, total, outer, pool=0.0, diagonal=0.0, temper=1.0)
    point = rng.standard_normal((5, 3))
    pooled = sum(np.cov(v.T, bias=True) for v in x) / 2
    grand = np.concatenate(x).mean(axis=0)
    whole = outer.sum(axis=0) / 600 - np.outer(grand, grand)
    gap = np.zeros(5)
    for k, sign in ((0, -1), (1, 1)):
        share = 3 / 303
        cov = (1 - share) * np.cov(x[k].T, bias=True) + share * pooled + 1e-4 * np.trace(whole) / 3 * np.eye(3)
        d = point - x[k].mean(axis=0)
        gap += sign * -0.5 * (np.einsum("ni,ij,nj->n", d, np.linalg.inv(cov), d) + np.linalg.slogdet(cov)[1])
    assert np.allclose(model.score(point), 1 / (1 + np.exp(-gap)), atol=1e-6)


def test_quality_accuracy_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    stats = document_statistics(docs)
    score, predicted, y = held_out_rows(score_quality(stats, fit_quality(stats, labels)), labels, "quality")
    assert auc(score, y) > 0.99
    assert (predicted == y).mean() > 0.98


def test_quality_on_awkward_rows(spark):
    docs = table(spark, AWKWARD, clash=True)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(len(AWKWARD))] + [(None, 1, 1), (5, None, None), (3, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    stats = document_statistics(docs.repartition(4))
    model = fit_quality(stats, labels)
    rows = score_quality(stats, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    assert keep_good(docs, model).columns == docs.columns
    assert np.isfinite(statistics(b"")).all() and len(statistics(b"")) == len(FEATURES)
    nothing = fit_quality(document_statistics(docs.limit(0)), labels)
    assert {r["score"] for r in score_quality(stats, nothing).collect()} == {0.5}
    assert score_quality(document_statistics(docs.limit(0)), model).count() == 0


def test_gradients():
    rng = np.random.default_rng(0)
    net = tox.Network.start(np.zeros(0, np.uint64), np.zeros(0, np.float32), np.zeros(1 << tox.GRAM_BITS, np.float32))
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64) + rng.standard_normal(net.p[k].shape) * 0.2
    x, idx = rng.standard_normal((9, 3 + 2 * tox.EMBED)), rng.integers(0, 9, (tox.WINDOW, 5))
    mask = (np.arange(tox.WINDOW)[:, None] < np.array([tox.WINDOW, 3, 10, tox.WINDOW, 1])).astype(float)
    y = np.array([1, 0, 1, 0, 1.0])

    def loss():
        z = net.forward(x, idx, mask)
        return (np.log1p(np.exp(z)) - y * z).mean()

    tape = {}
    z = net.forward(x, idx, mask, tape)
    grads, dx = net.backward(x, idx, mask, tape, (1 / (1 + np.exp(-z)) - y) / 5)
    for array, grad in [*((net.p[k], grads[k]) for k in ("wf", "wb", "uf", "ub", "bf", "bb", "wa", "va", "wo", "bo")), (x, dx)]:
        at = tuple(rng.integers(0, s) for s in array.shape)
        old = array[at]
        array[at] = old + 1e-4
        up = loss()
        array[at] = old - 1e-4
        down = loss()
        array[at] = old
        assert abs((up - down) / 2e-4 - grad[at]) < 1e-4


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 55, 56, 57, 1000):
        starts = tox.window_starts(n)
        assert set(range(n)) == {w for s in starts for w in range(s, min(n, s + tox.WINDOW))}


def test_planted_toxic_words_are_learnt(spark):
    rng = random.Random(2)
    bad = ["grobnik", "vilotar", "smurgel"]
    texts, y = [], []
    for k in range(900):
        w = invented(rng, rng.randint(10, 300)).split()
        if k % 3 == 0:
            for _ in range(rng.randint(1, 4)):
                w.insert(rng.randint(0, len(w)), rng.choice(bad) + rng.choice(["", "", ".", "!"]))
        texts.append(" ".join(w))
        y.append(int(k % 3 == 0))
    docs = table(spark, texts, clash=True).repartition(4)
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(y)], "doc_id long, quality int, toxic int")
    score, predicted, truth = held_out_rows(tox.score_toxicity(docs, tox.fit_toxicity(docs, labels)).drop("quality"), labels, "toxic")
    assert auc(score, truth) > 0.98
    assert (predicted == truth).mean() > 0.95


def test_class_share_is_put_back(spark):
    """A sample of another share differs from the uncapped fit by a shift; caps at the true share need none."""
    ids = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5]
    texts = [f"word{k} " + ("vile slur" if k % 8 == 0 else "calm day") for k in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, int(k % 8 == 0)) for k in range(400)], "doc_id long, quality int, toxic int")
    n1 = sum(k % 8 == 0 for k in ids)
    n0 = len(ids) - n1
    net = tox.fit_toxicity(docs, labels, max_toxic=20, max_other=20)
    taken = {y: sorted(tox_ids)[:20] for y, tox_ids in _by_hash(spark, ids).items()}
    chosen = sorted((k, y) for y, own in taken.items() for _, k in own)
    plain = tox.train([texts[k].encode() for k, _ in chosen], np.array([y for _, y in chosen]))
    assert abs(float(net.p["bo"][0] - plain.p["bo"][0]) - np.log(n1 / n0)) < 1e-4
    assert tox.prior_shift(30, 70, 30, 70) == 0


def _by_hash(spark, ids):
    rows = spark.createDataFrame([(k,) for k in ids], "doc_id long").selectExpr("doc_id", "xxhash64(doc_id) h").collect()
    return {y: [(r["h"], r["doc_id"]) for r in rows if int(r["doc_id"] % 8 == 0) == y] for y in (0, 1)}


def test_passages_of_17_words_lie_in_one_window():
    for n in (33, 50, 100, 333):
        starts = tox.window_starts(n)
        assert all(any(a <= at and at + 17 <= a + tox.WINDOW for a in starts) for at in range(n - 16))


def test_toxicity_on_awkward_rows(spark):
    docs = table(spark, AWKWARD, clash=True)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(len(AWKWARD))], "doc_id long, quality int, toxic int")
    net = tox.fit_toxicity(docs, labels)
    rows = {r["doc_id"]: r for r in tox.score_toxicity(docs.repartition(4), net).collect()}
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows.values())
    assert rows[0]["score"] < 1e-6 and rows[0]["n_windows"] == 0
    untrained = tox.fit_toxicity(docs, labels.limit(0))
    assert tox.score_toxicity(docs, untrained).count() == len(AWKWARD)
    assert tox.score_toxicity(docs.limit(0), net).count() == 0


def plain_statistics(raw):
    """The statistics by loops over bytes, words and lines."""
    import math

    kind = {}
    for c in range(256):
        ch = chr(c)
        kind[c] = ("beyond" if c >= 128 else "lower" if "a" <= ch <= "z" else "upper" if "A" <= ch <= "Z" else "digit" if ch.isdigit()
                   else "space" if ch in " \t" else "newline" if ch in "\n\r" else "stop" if ch in ".,;:?!'\"()-" else
                   "symbol" if 33 <= c < 127 else "other")
    n = {k: sum(kind[b] == k for b in raw) for k in set(kind.values())}
    words, lines, total = raw.split(), raw.split(b"\n"), max(1, len(raw))
    w = max(1, len(words))
    letters = max(1, n["lower"] + n["upper"] + n["beyond"])
    pairs = list(zip(words, words[1:]))
    symbols = [c for c in range(256) if kind[c] in ("stop", "symbol", "beyond")][:40]
    entropy = -sum(raw.count(c) / total * math.log(raw.count(c) / total) for c in set(raw))
    log1p, root = math.log1p, math.sqrt
    return [log1p(len(raw)), log1p(len(words)), log1p(len(lines)), log1p((len(raw) - n["space"] - n["newline"]) / w), root(n["upper"] / letters),
            root(n["digit"] / total), root(n["symbol"] / total), root(n["stop"] / total), root(n["space"] / total), root(n["newline"] / total),
            root(n["beyond"] / total), root(sum(chr(x[-1]) in "#$%&*!|" for x in words) / w), log1p(sum(c in raw for c in symbols)),
            log1p(len(set(words))) - log1p(len(words)), root(max([words.count(x) for x in set(words)], default=0) / w),
            root(1 - len(set(pairs)) / len(pairs)) if pairs else 0, root(1 - len(set(lines)) / len(lines)), root(sum(a == b for a, b in pairs) / w),
            log1p(len(words) / len(lines)), root(sum(x.isupper() for x in words) / w), root((raw.count(b".") + raw.count(b",")) / w), entropy]


def test_statistics_and_moments_equal_plain_ones(spark, monkeypatch):
    from quarry.llm import quality

    rng = random.Random(4)
    texts = [t for t in AWKWARD if t is None or len(t) < 500] + [
        invented(rng, rng.randint(0, 60)) + rng.choice(["", " THE #END! 12", "\nline\nline\n", "a, b; (c) ~ {d}"]) for _ in range(60)]
    raw = [(t or "").encode() for t in texts]
    for x in raw:
        assert np.allclose(statistics(x), plain_statistics(x), atol=1e-9), x
    y = {i: i % 2 for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5}
    seen = []
    real = quality.Discriminant.fit
    monkeypatch.setattr(quality.Discriminant, "fit", staticmethod(lambda *a: seen.append(a) or real(*a)))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    model = fit_quality(document_statistics(table(spark, texts).repartition(5)), labels)
    count, total, outer = seen[0][:3]
    for k in (0, 1):
        own = np.array([plain_statistics(raw[i]) for i, v in y.items() if v == k])
        assert count[k] == len(own) and np.allclose(total[k], own.sum(axis=0)) and np.allclose(outer[k], own.T @ own)
    scored = {r["doc_id"]: r["score"] for r in score_quality(document_statistics(table(spark, texts)), model).collect()}
    assert np.allclose([scored[i] for i in range(len(texts))], [model.score(np.array([plain_statistics(x)]))[0] for x in raw], atol=1e-9)


def plain_logit(net, words):
    """A window's logit, word by word and step by step; ``words`` are byte strings in lower case."""
    from quarry.llm.textops import mix, placed_words

    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    inputs = []
    for w in words:
        marked = [1, *w, 1]
        buckets = []
        for n in tox.GRAMS:
            for a in range(len(marked) - n + 1):
                value = 0
                for c in marked[a:a + n]:
                    value = (value * 1099511628211 + c) % (1 << 64)
                buckets.append(int(mix(np.array([(value + n) % (1 << 64)], np.uint64))[0] >> np.uint64(64 - tox.GRAM_BITS)))
        data = np.frombuffer(w, np.uint8)
        h = placed_words(data, np.array([0, len(data)]))[0][0]
        slot = int(np.searchsorted(net.vocabulary, h))
        known = slot < len(net.vocabulary) and net.vocabulary[slot] == h
        slot = slot if known else len(net.vocabulary)
        odds = [float(net.gram_odds[b]) for b in buckets]
        char = np.mean([net.p["char"][b % (1 << tox.EMBED_BITS)] for b in buckets], axis=0)
        inputs.append(np.r_[net.word_odds[slot] if known else 0, max(odds), np.mean(odds), net.p["word"][slot], char])
    states = []
    for side, order in (("f", range(len(words))), ("b", range(len(words) - 1, -1, -1))):
        h, out = np.zeros(tox.HIDDEN), {}
        for t in order:
            x = inputs[t] @ net.p[f"w{side}"] + net.p[f"b{side}"]
            u = h @ net.p[f"u{side}"]
            k = tox.HIDDEN
            z, r = sigmoid(x[:k] + u[:k]), sigmoid(x[k:2 * k] + u[k:2 * k])
            new = np.tanh(x[2 * k:] + r * u[2 * k:])
            h = z * h + (1 - z) * new
            out[t] = h
        states.append(out)
    both = [np.r_[states[0][t], states[1][t]] for t in range(len(words))]
    e = np.array([np.tanh(h @ net.p["wa"]) @ net.p["va"] for h in both])
    weight = np.exp(e - e.max()) / np.exp(e - e.max()).sum()
    return float(sum(a * h for a, h in zip(weight, both)) @ net.p["wo"] + net.p["bo"][0])


def test_scores_equal_a_plain_network_over_all_windows(spark):
    from tests.llm.fixtures import words

    rng = random.Random(6)
    texts = [" ".join(rng.choices(["calm", "day", "été", "Sun", "42", "grobnik", "VILE", "x"], k=rng.choice([0, 1, 5, 31, 32, 33, 48, 49, 90]))) for _ in range(80)]
    net = tox.train([t.encode() for t in texts], np.array([int("grobnik" in t) for t in texts]), epochs=1)
    got = {r["doc_id"]: r for r in tox.score_toxicity(table(spark, texts).repartition(3), net).collect()}
    for k, t in enumerate(texts):
        own = [w.encode() for w in words(t)]
        starts = [a for a in range(0, max(1, len(own)), tox.STRIDE) if a == 0 or a + tox.WINDOW - tox.STRIDE < len(own)] if own else []
        logits = [plain_logit(net, own[a:a + tox.WINDOW]) for a in starts]
        want = 1 / (1 + np.exp(-max(logits, default=tox.EMPTY)))
        assert got[k]["n_windows"] == len(starts), (len(own), got[k]["n_windows"])
        assert abs(got[k]["score"] - want) < 1e-4
