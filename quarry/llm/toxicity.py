"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input joins a word part (an embedding and the word's log-odds between
toxic and other training documents) and a character part (the mean embedding of
its byte n-grams and the largest and mean log-odds of these). A forward and a
backward GRU read a window of words, attention pools the states, and a linear
layer gives the window's logit. Windows overlap and cover the whole text; a
document's logit is its largest window's.

Training runs in numpy on a bounded sample of labelled documents: only documents
are labelled, so each is represented by its window with the largest logit, chosen
anew in every round. The log-odds a document is trained with come from the other
half of the sample, as its own label must not leak into its input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.quality import held_out, known_labels
from quarry.llm.textops import lower_bytes, mix, placed_words, slices, text_buffers

WINDOW, STRIDE = 32, 16  # a passage of up to 17 words lies whole in one window
HIDDEN, ATTENTION, EMBED = 8, 8, 4
GRAMS = (3, 4, 5)
GRAM_BITS, EMBED_BITS = 16, 12
EMPTY = -20.0  # logit of a text without words


def gram_buckets(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of the byte n-grams of the words at ``data[s:e]``, each between two end marks; by word."""
    size = e - s + 2
    first = np.cumsum(size) - size
    word = np.repeat(np.arange(len(s)), size)
    at = np.arange(len(word)) - first[word]
    raw = np.full(len(word), 1, np.uint64)  # 1 marks an end
    inner = (at > 0) & (at < size[word] - 1)
    raw[inner] = lower_bytes(data[(s[word] + at - 1)[inner]])
    grams, owner, place = [], [], []
    value = np.zeros(len(raw), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        m = max(0, len(raw) - n + 1)
        value = value[:m] * np.uint64(1099511628211) + raw[n - 1:n - 1 + m]
        if n in GRAMS:
            ok = np.flatnonzero(at[:m] + n <= size[word[:m]])
            grams.append(mix(value[ok] + np.uint64(n)) >> np.uint64(64 - GRAM_BITS))
            owner.append(word[ok])
            place.append(ok)
    order = np.argsort(np.concatenate(owner), kind="stable")
    return np.concatenate(grams)[order].astype(np.int32), np.concatenate(owner)[order].astype(np.int32)


def window_starts(n: int) -> np.ndarray:
    """First words of the windows that cover ``n`` words."""
    return np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE) if n else np.zeros(0, np.int64)


@dataclass
class Network:
    """Parameters by name, and the vocabulary they refer to."""

    p: dict[str, np.ndarray]
    vocabulary: np.ndarray  # sorted word hashes
    word_odds: np.ndarray
    gram_odds: np.ndarray
    moments: dict = field(default_factory=dict, repr=False)

    @staticmethod
    def start(vocabulary: np.ndarray, word_odds: np.ndarray, gram_odds: np.ndarray, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        d = 3 + 2 * EMBED
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3 / np.sqrt(shape[0])).astype(np.float32)
        p = {"word": np.zeros((len(vocabulary) + 1, EMBED), np.float32), "char": draw(1 << EMBED_BITS, EMBED),
             "va": draw(ATTENTION), "wa": draw(2 * HIDDEN, ATTENTION), "wo": draw(2 * HIDDEN),
             "bo": np.zeros(1, np.float32)}
        for side in "fb":
            p |= {f"w{side}": draw(d, 3 * HIDDEN), f"b{side}": np.zeros(3 * HIDDEN, np.float32), f"u{side}": draw(HIDDEN, 3 * HIDDEN)}
        return Network(p, vocabulary, word_odds, gram_odds)

    # -- inputs -----------------------------------------------------------------
    def word_slots(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary number of each word; the last one is for unknown words."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, len(self.vocabulary))

    def inputs(self, slots: np.ndarray, bucket: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Input vectors of distinct words, from their vocabulary numbers and n-grams."""
        n = len(slots)
        x = np.empty((n, 3 + 2 * EMBED), np.float32)
        if not n:
            return x
        first = np.searchsorted(owner, np.arange(n))  # every word has an n-gram
        count = np.diff(np.r_[first, len(owner)]).astype(np.float32)
        odds = self.gram_odds[bucket]
        x[:, 0] = np.r_[self.word_odds, np.float32(0)][slots]
        x[:, 1] = np.maximum.reduceat(odds, first)
        x[:, 2] = np.add.reduceat(odds, first) / count
        x[:, 3:3 + EMBED] = self.p["word"][slots]
        part = self.p["char"][bucket & ((1 << EMBED_BITS) - 1)]
        x[:, 3 + EMBED:] = np.add.reduceat(part, first, axis=0) / count[:, None]
        return x

    # -- network ----------------------------------------------------------------
    def _gru(self, side: str, projected: np.ndarray, idx: np.ndarray, mask: np.ndarray, tape: list | None) -> np.ndarray:
        """States (L, N, H); ``projected`` holds each distinct word's input product."""
        u = self.p[f"u{side}"]
        steps, n = idx.shape
        h = np.zeros((n, HIDDEN), np.float32)
        out = np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            x = projected[idx[t]]
            hu = h @ u
            gate = 1 / (1 + np.exp(-(x[:, :2 * HIDDEN] + hu[:, :2 * HIDDEN])))
            z, r = gate[:, :HIDDEN], gate[:, HIDDEN:]
            new = np.tanh(x[:, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
            m = mask[t][:, None]
            if tape is not None:
                tape.append((t, h, z, r, new, hu[:, 2 * HIDDEN:]))
            h = h + m * (1 - z) * (new - h)
            out[t] = h
        return out

    def forward(self, x: np.ndarray, idx: np.ndarray, mask: np.ndarray, tape: dict | None = None) -> np.ndarray:
        """Logits of windows: ``idx`` (L, N) numbers the rows of ``x``, ``mask`` is 0 beyond a window's end."""
        p = self.p
        states = []
        for side in "fb":
            record = None if tape is None else tape.setdefault(side, [])
            states.append(self._gru(side, x @ p[f"w{side}"] + p[f"b{side}"], idx, mask, record))
        h = np.concatenate(states, axis=2)
        a = np.tanh(h @ p["wa"])
        e = a @ p["va"]
        e = np.where(mask > 0, e, -np.inf)
        weight = np.exp(e - e.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * h).sum(axis=0)
        if tape is not None:
            tape |= {"h": h, "a": a, "weight": weight, "pooled": pooled}
        return pooled @ p["wo"] + p["bo"][0]

    def backward(self, x, idx, mask, tape, d_logit) -> tuple[dict, np.ndarray]:
        """Gradients of the parameters and of the rows of ``x``."""
        p, g = self.p, {}
        h, a, weight, pooled = tape["h"], tape["a"], tape["weight"], tape["pooled"]
        g["wo"], g["bo"] = pooled.T @ d_logit, np.array([d_logit.sum()])
        d_pooled = d_logit[:, None] * p["wo"]
        d_weight = (h * d_pooled).sum(axis=2)
        d_e = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["va"] = np.einsum("tna,tn->a", a, d_e)
        d_a = d_e[:, :, None] * p["va"] * (1 - a * a)
        g["wa"] = np.einsum("tnh,tna->ha", h, d_a)
        d_h = weight[:, :, None] * d_pooled + d_a @ p["wa"].T
        dx = np.zeros_like(x)
        for k, side in enumerate("fb"):
            own = d_h[:, :, k * HIDDEN:(k + 1) * HIDDEN]
            u, w = p[f"u{side}"], p[f"w{side}"]
            gu, flow = np.zeros_like(u), np.zeros_like(own[0])
            d_in = np.zeros((len(x), 3 * HIDDEN), np.float32)
            for t, h0, z, r, new, hn in reversed(tape[side]):
                flow = flow + own[t]
                m = mask[t][:, None]
                d_new = flow * m * (1 - z) * (1 - new * new)
                d_z = flow * m * (h0 - new) * z * (1 - z)
                d_r = d_new * hn * r * (1 - r)
                d_hu = np.concatenate([d_z, d_r, d_new * r], axis=1)
                np.add.at(d_in, idx[t], np.concatenate([d_z, d_r, d_new], axis=1))
                gu += h0.T @ d_hu
                flow = flow * (1 - m * (1 - z)) + d_hu @ u.T
            g[f"u{side}"], g[f"w{side}"], g[f"b{side}"] = gu, x.T @ d_in, d_in.sum(axis=0)
            dx += d_in @ w.T
        return g, dx

    def step(self, grads: dict, number: int, rate: float) -> None:
        """One Adam update."""
        for name, grad in grads.items():
            m, v = self.moments.setdefault(name, (np.zeros_like(self.p[name]), np.zeros_like(self.p[name])))
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            self.p[name] -= rate * (m / (1 - 0.9 ** number)) / (np.sqrt(v / (1 - 0.99 ** number)) + 1e-6)


class Texts:
    """Words, distinct words and windows of some rows of text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.hashes, self.before, s, e = placed_words(data, offsets)
        self.distinct, first, self.number = np.unique(self.hashes, return_index=True, return_inverse=True)
        self.bucket, self.owner = gram_buckets(data, s[first], e[first])
        starts = [window_starts(n) for n in np.diff(self.before)]
        self.row = np.repeat(np.arange(len(starts)), [len(x) for x in starts])
        begin = np.concatenate([*starts, np.zeros(0, np.int64)]).astype(np.int64) + self.before[self.row]
        at = begin[None, :] + np.arange(WINDOW)[:, None]
        inside = at < self.before[self.row + 1]
        self.idx = np.where(inside, self.number[np.where(inside, at, 0)], 0).astype(np.int32) if len(begin) else np.zeros((WINDOW, 0), np.int32)
        self.mask = inside.astype(np.float32)

    def logits(self, net: Network, group: int = 4096) -> np.ndarray:
        """The logit of each window."""
        if not len(self.row):
            return np.zeros(0, np.float32)
        x = net.inputs(net.word_slots(self.distinct), self.bucket, self.owner)
        return np.concatenate([net.forward(x, self.idx[:, a:a + group], self.mask[:, a:a + group])
                               for a in range(0, len(self.row), group)])

    def document_logits(self, net: Network) -> np.ndarray:
        out = np.full(len(self.before) - 1, EMPTY)
        np.maximum.at(out, self.row, self.logits(net))
        return out


def _odds(n1: np.ndarray, n0: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Shrunk log-odds of a toxic document, from the numbers of toxic and other documents with each feature."""
    t1, t0 = max(1, y.sum()), max(1, (1 - y).sum())
    odds = np.log((n1 + 0.1) / (t1 + 1)) - np.log((n0 + 0.1) / (t0 + 1))
    return np.clip(odds * (n1 + n0) / (n1 + n0 + 4), -3, 6).astype(np.float32) / 3


def _vocabulary(texts: list[Texts], rows: list[np.ndarray], y: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, their log-odds, n-gram log-odds) from the given rows of each chunk."""
    words, label = [], []
    grams = np.zeros((2, 1 << GRAM_BITS))
    for text, own, labels in zip(texts, rows, y, strict=True):
        by_word = np.searchsorted(text.owner, np.arange(len(text.distinct) + 1))
        for row in own:
            numbers = np.unique(text.number[text.before[row]:text.before[row + 1]])
            words.append(text.distinct[numbers])
            label.append(labels[row])
            seen = np.concatenate([text.bucket[by_word[k]:by_word[k + 1]] for k in numbers] or [np.zeros(0, np.int32)])
            grams[int(labels[row]), np.unique(seen)] += 1
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.float32), np.zeros(1 << GRAM_BITS, np.float32)
    label = np.array(label, np.float64)
    keys, number = np.unique(np.concatenate(words), return_inverse=True)
    holder = np.repeat(label, [len(w) for w in words])
    odds = _odds(np.bincount(number, holder, len(keys)), np.bincount(number, 1 - holder, len(keys)), label)
    keep = np.abs(odds) > 0.25
    gram_odds = np.where(grams.sum(axis=0) > 0, _odds(grams[1], grams[0], label), 0).astype(np.float32)
    return keys[keep], odds[keep], gram_odds


def train(texts: list[bytes], y: np.ndarray, rounds: int = 2, epochs: int = 4, batch: int = 128, rate: float = 0.01,
          seed: int = 7) -> Network:
    """Train on texts with labels 0 or 1."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    chunks, labels = [], []
    for a in range(0, len(order), 256):
        own = order[a:a + 256]
        offsets = np.cumsum([0, *(len(texts[i]) for i in own)])
        chunks.append(Texts(np.frombuffer(b"".join(texts[i] for i in own), np.uint8), offsets))
        labels.append(np.asarray(y)[own].astype(np.float64))
    everything = [np.arange(len(v)) for v in labels]
    net = Network.start(*_vocabulary(chunks, everything, labels), seed)
    halves = [[v[k::2] for v in everything] for k in (0, 1)]
    crossed = [_vocabulary(chunks, halves[1 - k], labels) for k in (0, 1)]  # for half k, from the other half
    number = 0
    for turn in range(rounds):
        chosen = []  # (x parts, window) of each document's largest window
        for k in (0, 1):
            view = _with_odds(net, crossed[k])
            for text, rows, label in zip(chunks, halves[k], labels, strict=True):
                if not len(text.row):
                    continue
                x = view.inputs(view.word_slots(text.distinct), text.bucket, text.owner)
                if turn:
                    logit = text.logits(view)
                else:  # untrained: the window with the largest log-odds
                    logit = np.where(text.mask > 0, x[text.idx, 0] + 0.1 * x[text.idx, 1], -9).max(axis=0)
                by = np.lexsort((logit, text.row))
                last = np.r_[text.row[by][1:] != text.row[by][:-1], True]
                best = by[last][np.isin(text.row[by][last], rows)]
                if len(best):
                    chosen.append((view, text, best, label[text.row[best]]))
        steps = sum(max(1, len(best) // batch) for _, _, best, _ in chosen)
        for _ in range(max(epochs, 200 // max(1, steps))):  # few documents: more passes over them
            for c in rng.permutation(len(chosen)):
                view, text, best, label = chosen[c]
                for part in np.array_split(rng.permutation(len(best)), max(1, len(best) // batch)):
                    number += 1
                    _learn(net, view, text, best[part], label[part], number, rate * (1 - 0.7 * turn / rounds))
    return net


def _with_odds(net: Network, parts: tuple) -> Network:
    """The same parameters, with the words and log-odds of other documents."""
    view = Network(net.p, net.vocabulary, np.zeros(len(net.vocabulary), np.float32), parts[2])
    if len(parts[0]) and len(net.vocabulary):
        at = np.minimum(np.searchsorted(parts[0], net.vocabulary), len(parts[0]) - 1)
        view.word_odds = np.where(parts[0][at] == net.vocabulary, parts[1][at], 0).astype(np.float32)
    return view


def _learn(net: Network, view: Network, text: Texts, windows: np.ndarray, y: np.ndarray, number: int, rate: float) -> None:
    used, idx = np.unique(text.idx[:, windows], return_inverse=True)
    idx = idx.reshape(WINDOW, -1)
    mine = np.isin(text.owner, used)
    bucket, owner = text.bucket[mine], np.searchsorted(used, text.owner[mine])
    slots = view.word_slots(text.distinct[used])
    x = view.inputs(slots, bucket, owner)
    mask = text.mask[:, windows]
    tape: dict = {}
    logit = net.forward(x, idx, mask, tape)
    d_logit = ((1 / (1 + np.exp(-logit)) - y) / len(y)).astype(np.float32)
    grads, dx = net.backward(x, idx, mask, tape, d_logit)
    grads["word"] = np.zeros_like(net.p["word"])
    np.add.at(grads["word"], slots, dx[:, 3:3 + EMBED])
    count = np.maximum(1, np.bincount(owner, minlength=len(used))).astype(np.float32)
    grads["char"] = np.zeros_like(net.p["char"])
    np.add.at(grads["char"], bucket & ((1 << EMBED_BITS) - 1), (dx[:, 3 + EMBED:] / count[:, None])[owner])
    net.step(grads, number, rate)


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_toxic: int = 1500, max_other: int = 2500) -> Network:
    """Train on a bounded sample of the labelled rows that are not held out.

    At most ``max_toxic`` and ``max_other`` documents are taken, those with the least hash
    of their id; without rows of both classes the network stays untrained. The sample's
    share of toxic documents is put back to that of all labelled rows by a shift of the
    last bias. Of rows that share an id one is learnt from.
    """
    # Ids are chosen without their texts; the texts of at most max_toxic + max_other ids are then picked by a broadcast of these.
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct().join(known_labels(labels, label), "doc_id")
    chosen = None
    for k, most in ((1, max_toxic), (0, max_other)):
        own = ids.where(F.col("y") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = own if chosen is None else chosen.unionByName(own)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Of rows that share an id the least text is taken, in Spark: at most a row for each chosen id reaches the driver.
    sample = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).collect()
    sample.sort(key=lambda r: r["doc_id"])
    texts, y = [r["text"].encode("utf-8", "replace") for r in sample], [r["y"] for r in sample]
    if len(set(y)) < 2:
        return Network.start(np.zeros(0, np.uint64), np.zeros(0, np.float32), np.zeros(1 << GRAM_BITS, np.float32))
    net = train(texts, np.array(y))
    every = {r["y"]: r["count"] for r in ids.groupBy("y").count().collect()}
    net.p["bo"] += np.float32(prior_shift(every[1], every[0], sum(y), len(y) - sum(y)))
    return net


def prior_shift(toxic: int, other: int, sample_toxic: int, sample_other: int) -> float:
    """What a logit learnt on the sample lacks at the class share of all labelled documents."""
    return float(np.log(toxic / other) - np.log(sample_toxic / sample_other))


def score_toxicity(docs: DataFrame, net: Network, threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_windows`` for each row of ``docs(doc_id, text)``.

    Null texts and texts without words score 0 (the logit ``EMPTY``). Repeated rows each
    give a row. Other columns are ignored.
    """
    fixed = Network(net.p, net.vocabulary, net.word_odds, net.gram_odds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            logit, windows = np.full(batch.num_rows, EMPTY), np.zeros(batch.num_rows, np.int64)
            for a, b in slices(offsets):
                text = Texts(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                logit[a:b] = text.document_logits(fixed)
                windows[a:b] = np.bincount(text.row, minlength=b - a)
            score = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(score), pa.array((score >= threshold).astype(np.int32)),
                 pa.array(windows)], names=["doc_id", "held_out", "score", "predicted", "n_windows"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int, n_windows long")
