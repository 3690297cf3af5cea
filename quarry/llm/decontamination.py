"""Benchmark decontamination by a prefix-filtered set join.

Every window of ``window`` consecutive words of a benchmark item (an item of fewer
words is one window) is a set of short shingles. A document holds the window only
if it holds all of them, so it must hold the window's rarest one: at containment
1 the necessary prefix of the rarity order is a single shingle. The join therefore

1. counts over all documents how often each benchmark shingle occurs;
2. joins document shingles with the prefix shingle of each window;
3. bounds by position and length: the shingle's place in the window fixes where
   the window would begin, which must leave room for it in the document;
4. verifies the window's words there, first by their hashes, then by their bytes.

The benchmark side is broadcast only while its windows are within
``max_broadcast_words``; for a larger benchmark the same four steps are Spark joins
and aggregates (same rows), with texts known by their SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.textops import lists, lower_bytes, placed_words, runs, slices, text_buffers, words

SHINGLE = 3


class Windows:
    """The distinct windows of a bounded set of items."""

    def __init__(self, items: list[tuple], window: int) -> None:
        self.window = window
        places: dict[bytes, list[int]] = {}  # a window's words, space-joined, to item numbers
        flat: list[np.ndarray] = []
        self.ids = sorted({i for i, _, _ in items if i is not None})
        number = {item: k for k, item in enumerate(self.ids)}
        for item, hashes, own_words in items:
            if item is None or not len(hashes):
                continue
            size = min(window, len(hashes))
            for at in range(len(hashes) - size + 1):
                key = b" ".join(own_words[at:at + size])
                if key not in places:
                    places[key] = []
                    flat.append(hashes[at:at + size])
                held = places[key]
                if not held or held[-1] != number[item]:
                    held.append(number[item])
        self.phrases = list(places)
        self.sizes = np.array([len(f) for f in flat], np.int64)
        self.items = [sorted(set(v)) for v in places.values()]
        self.whole = np.array([runs(f, len(f))[0] for f in flat], np.uint64)
        self.flat = flat
        # Shingles of a window: runs of SHINGLE words, of all its words if it has fewer.
        self.shingles = [runs(f, min(SHINGLE, len(f))) for f in flat]
        self.distinct = np.unique(np.concatenate(self.shingles)) if flat else np.zeros(0, np.uint64)
        self.shingle_sizes = sorted({min(SHINGLE, int(s)) for s in self.sizes})

    def choose(self, counts: np.ndarray) -> None:
        """Set each window's prefix: its rarest shingle by ``counts`` (aligned with ``distinct``)."""
        prefix, place = [], []
        for own in self.shingles:
            order = np.lexsort((own, counts[np.searchsorted(self.distinct, own)]))
            prefix.append(own[order[0]])
            place.append(int(order[0]))
        prefix, place = np.array(prefix, np.uint64), np.array(place, np.int64)
        by = np.argsort(prefix, kind="stable")
        self.by, self.place = by, place[by]
        self.keys, first = np.unique(prefix[by], return_index=True)
        self.first = np.r_[first, len(by)]

    def candidates(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word number, window number) where a window's prefix puts its begin; before any bound."""
        begins, found = [], []
        for size in self.shingle_sizes:
            own = runs(hashes, size)
            if not len(own) or not len(self.keys):
                continue
            slot = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
            hits = np.flatnonzero(self.keys[slot] == own)
            if not len(hits):
                continue
            lo, n = self.first[slot[hits]], self.first[slot[hits] + 1] - self.first[slot[hits]]
            at = np.repeat(hits, n)
            which = np.repeat(lo, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            begins.append(at - self.place[which])
            found.append(self.by[which])
        if not begins:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(begins), np.concatenate(found)

    def occurrences(self, hashes: np.ndarray, row_of: np.ndarray, before: np.ndarray, spelt: Spelling) -> tuple[np.ndarray, np.ndarray]:
        """(word number, window number) of verified windows that lie within one row."""
        begin, which = self.candidates(hashes)
        size = self.sizes[which]
        ok = (begin >= 0) & (begin + size <= len(hashes))
        begin, which, size = begin[ok], which[ok], size[ok]
        if not len(begin):
            return begin, which
        ok = begin + size <= before[row_of[begin] + 1]  # the length bound of the row
        begin, which = begin[ok], which[ok]
        if not len(begin):
            return begin, which
        keep = np.fromiter((np.array_equal(hashes[b:b + len(self.flat[w])], self.flat[w])
                            and spelt.phrase(b, len(self.flat[w])) == self.phrases[w]
                            for b, w in zip(begin.tolist(), which.tolist(), strict=True)), bool, len(begin))
        return begin[keep], which[keep]


class Spelling:
    """The words of some texts as bytes, A-Z lower-cased."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        self.raw, self.begin, self.end = lower_bytes(data).tobytes(), begin, end

    def words(self, first: int, n: int) -> list[bytes]:
        return [self.raw[a:b] for a, b in zip(self.begin[first:first + n].tolist(), self.end[first:first + n].tolist(), strict=True)]

    def phrase(self, first: int, n: int) -> bytes:
        """``n`` words from number ``first``, space-joined; a word has no space."""
        return b" ".join(self.words(first, n))


def _spelt(text: str | None) -> tuple[np.ndarray, Spelling]:
    """(word hashes, words) of one text."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    hashes, _, begin, end = placed_words(data, np.array([0, len(data)], np.int64))
    return hashes, Spelling(data, begin, end)


def _item_words(benchmark: DataFrame) -> list[tuple]:
    rows = benchmark.selectExpr("cast(item_id as string) as item_id", "cast(text as string) as text").collect()
    out = []
    for r in rows:
        hashes, spelt = _spelt(r["text"])
        out.append((r["item_id"], hashes, spelt.words(0, len(hashes))))
    return out


def _spelt_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, Spelling]]:
    data, offsets = text_buffers(column)
    for a, b in slices(offsets):
        own = data[offsets[a]:offsets[b]]
        hashes, before, begin, end = placed_words(own, offsets[a:b + 1] - offsets[a])
        yield a, b, hashes, before, Spelling(own, begin, end)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_buffers(batch.column(1))
    for a, b in slices(offsets):
        own = offsets[a:b + 1] - offsets[a]
        yield a, b, *words(data[offsets[a]:offsets[b]], own)


def shingle_counts(docs: DataFrame, held: Windows) -> np.ndarray:
    """Occurrences in all documents of each of the benchmark's own shingles."""
    distinct, sizes = held.distinct, held.shingle_sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(distinct), np.int64)
        for batch in batches:
            for _, _, hashes, _ in _slices(batch):
                for size in sizes:
                    own = runs(hashes, size)
                    slot = np.minimum(np.searchsorted(distinct, own), len(distinct) - 1)
                    np.add.at(counts, slot[distinct[slot] == own], 1)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["k", "n"])

    out = np.zeros(len(distinct), np.int64)
    if not len(distinct):
        return out
    # One row per benchmark shingle at most, within the benchmark's own bound.
    texts = docs.selectExpr("cast(null as bigint) as doc_id", "cast(text as string) as text")
    for r in texts.mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r["k"]] = r["n"]
    return out


SCHEMA = "doc_id long, n_words long, n_hit long, items array<string>"


def _broadcast_join(docs: DataFrame, held: Windows) -> DataFrame:
    held.choose(shingle_counts(docs, held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            n_words, n_hit, items = np.zeros(n, np.int64), np.zeros(n, np.int64), [[] for _ in range(n)]
            for a, b, hashes, before, spelt in _spelt_slices(batch.column(1)):
                n_words[a:b] = np.diff(before)
                row_of = np.repeat(np.arange(b - a), np.diff(before))
                begin, which = held.occurrences(hashes, row_of, before, spelt)
                if not len(begin):
                    continue
                edge = np.zeros(len(hashes) + 1, np.int64)
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + held.sizes[which], -1)
                hit = np.cumsum(edge)[:-1] > 0
                n_hit[a:b] = np.bincount(row_of[hit], minlength=b - a)
                for row, w in set(zip(row_of[begin].tolist(), which.tolist(), strict=True)):
                    items[a + row].extend(held.ids[i] for i in held.items[w])
            items = [sorted(set(x)) for x in items]
            flat = [x for y in items for x in y]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n_hit),
                 lists(flat, [len(x) for x in items], pa.string())], names=["doc_id", "n_words", "n_hit", "items"])

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text").mapInArrow(run, SCHEMA)


def overlap(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_broadcast_words: int = 200_000) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` per row of ``docs``; ``items`` are item ids as sorted strings.

    A document word inside any occurrence of a window of the benchmark is hit.
    Null texts and texts without words are never hit; items without words or
    with a null id are left out. Items sharing an id count as one. Rows may repeat.
    Other columns are ignored.
    """
    if _is_small(benchmark, max_broadcast_words):
        return _broadcast_join(docs, Windows(_item_words(benchmark), window))
    return _shuffle_join(docs, benchmark, window)


def _is_small(benchmark: DataFrame, max_words: int) -> bool:
    """A word and what parts it from the next have two bytes at least."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()[0]
    return size <= 2 * max_words


def _windows_table(benchmark: DataFrame, window: int) -> DataFrame:
    """``item, phrase, size, shingles``: the words (space-joined), their number and the shingle hashes of each window of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                hashes, spelt = _spelt(batch.column(1)[k].as_py())
                if not len(hashes):
                    continue
                size = min(window, len(hashes))
                own = min(SHINGLE, size)
                shingles = runs(hashes, own).view(np.int64)
                for a in range(0, len(hashes) - size + 1, 1 << 14):
                    at = np.arange(a, min(a + (1 << 14), len(hashes) - size + 1))
                    parts = shingles[at[:, None] + np.arange(size - own + 1)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column(0)[k].as_py()] * len(at), pa.string()),
                         pa.array([spelt.phrase(x, size) for x in at.tolist()], pa.binary()).cast(pa.string()),
                         pa.array(np.full(len(at), size)), lists(parts.ravel(), [size - own + 1] * len(at), pa.int64())],
                        names=["item", "phrase", "size", "shingles"])
    items = benchmark.where("item_id is not null")
    return items.selectExpr("cast(item_id as string) as item", "cast(text as string) as text").mapInArrow(
        run, "item string, phrase string, size long, shingles array<long>").distinct()


def _document_counts(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """``h, n``: how often each shingle of ``sizes`` words occurs in ``texts(_rid, _text)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, hashes, _ in _slices(batch):
                for size in sizes:
                    h, n = np.unique(runs(hashes, size), return_counts=True)  # runs over two rows only make one less rare
                    for a in range(0, len(h), 1 << 16):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(h[a:a + (1 << 16)].view(np.int64)), pa.array(n[a:a + (1 << 16)])], names=["h", "n"])
    return texts.select("_rid", "_text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _document_shingles(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """``rid, h, at, n_words``: the shingles of ``sizes`` words of each of ``texts(_rid, _text)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, hashes, before in _slices(batch):
                n_words = np.diff(before)
                row_of = np.repeat(np.arange(len(n_words)), n_words)
                for size in sizes:
                    got = runs(hashes, size)
                    ok = np.flatnonzero(row_of[:len(got)] == row_of[size - 1:]) if len(got) else np.zeros(0, np.int64)
                    for a in range(0, len(ok), 1 << 16):
                        at = ok[a:a + (1 << 16)]
                        row = row_of[at]
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(first + row)), pa.array(got[at].view(np.int64)),
                             pa.array(at - before[row]), pa.array(n_words[row])], names=["rid", "h", "at", "n_words"])
    return texts.select("_rid", "_text").mapInArrow(run, "rid binary, h long, at long, n_words long")


def _prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``h, place, phrase, size``: each window's rarest shingle by ``counts(h, n)``; a window with one that never occurs is left out."""
    every = windows.select("phrase", "size", F.posexplode("shingles").alias("place", "h"))
    known = every.join(counts, "h", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    rarest = known.groupBy("phrase", "size").agg(F.min(F.struct("n", "h", "place")).alias("p")).where("p.n > 0")
    return rarest.select("p.h", F.col("p.place").cast("bigint").alias("place"), "phrase", "size")


def _verified(candidates: DataFrame) -> DataFrame:
    """``rid, n_hit, phrases``: words inside windows that do stand where ``candidates(rid, text, found)`` say, and these windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit, phrases = [], []
            for k in range(batch.num_rows):
                hashes, spelt = _spelt(batch.column(1)[k].as_py())
                found = batch.column(2)[k].values
                hit, held = np.zeros(len(hashes), bool), set()
                for begin, size, phrase in zip(*(found.field(c).to_pylist() for c in ("begin", "size", "phrase")), strict=True):
                    if spelt.phrase(begin, size) == phrase.encode():
                        hit[begin:begin + size] = True
                        held.add(phrase)
                n_hit.append(int(hit.sum()))
                phrases.append(sorted(held))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_hit, pa.int64()), pa.array(phrases, pa.list_(pa.string()))],
                names=["rid", "n_hit", "phrases"])
    return candidates.select("rid", "text", "found").mapInArrow(run, "rid binary, n_hit long, phrases array<string>").where("n_hit > 0")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _hit_texts(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """``rid, n_hit, items`` of each distinct text with a window, by its digest: the prefix join as Spark joins.

    No side is broadcast by hand; of a text, its digest, places and candidates are joined and its words read again to verify.
    """
    table = _windows_table(benchmark, window)
    windows = table.select("phrase", "size", "shingles").distinct()
    sizes = [r["k"] for r in windows.select(F.least(F.col("size"), F.lit(SHINGLE)).alias("k")).distinct().collect()]  # SHINGLE numbers at most
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(text.alias("_text")).select(_digest(F.col("_text")).alias("_rid"), "_text").dropDuplicates(["_rid"])
    shingles = windows.select(F.explode("shingles").alias("h")).distinct()
    prefixes = _prefixes(windows, _document_counts(texts, sizes).join(shingles, "h", "left_semi"))
    begin = F.col("at") - F.col("place")
    candidates = (_document_shingles(texts, sizes).join(prefixes, "h")
                  .where((begin >= 0) & (begin + F.col("size") <= F.col("n_words")))
                  .groupBy("rid").agg(F.collect_list(F.struct(begin.alias("begin"), "size", "phrase")).alias("found")))
    found = _verified(candidates.join(texts, candidates["rid"] == texts["_rid"]).withColumnRenamed("_text", "text"))
    items = (found.select("rid", "n_hit", F.explode("phrases").alias("phrase")).join(table.select("item", "phrase").distinct(), "phrase")
             .groupBy("rid", "n_hit").agg(F.array_sort(F.collect_set("item")).alias("items")))
    return items


def _shuffle_join(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """The same rows by the same steps for a benchmark too large to broadcast."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _digest(text).alias("rid"), F.regexp_count(F.translate(
        text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(pattern)).cast("bigint").alias("n_words"))
    return rows.join(_hit_texts(docs, benchmark, window), "rid", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_broadcast_words: int = 200_000) -> DataFrame:
    """Counts and digest of :func:`overlap`, one row per input row."""
    return overlap(docs, benchmark, window, max_broadcast_words).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_broadcast_words: int = 200_000) -> DataFrame:
    """The rows of ``docs`` that no benchmark window occurs in, whole."""
    if not _is_small(benchmark, max_broadcast_words):
        # By the text, as ids may be null or repeated.
        hit = _hit_texts(docs, benchmark, window).select("rid")
        rows = docs.select(_digest(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("rid"), F.struct("*").alias("_row"))
        return rows.join(hit, "rid", "left_anti").select("_row.*")
    held = Windows(_item_words(benchmark), window)
    held.choose(shingle_counts(docs, held))

    @F.arrow_udf("boolean")
    def clean(text: pa.Array) -> pa.Array:
        out = np.ones(len(text), bool)
        for a, b, hashes, before, spelt in _spelt_slices(text):
            row_of = np.repeat(np.arange(b - a), np.diff(before))
            begin, _ = held.occurrences(hashes, row_of, before, spelt)
            out[a + row_of[begin]] = False
        return pa.array(out)

    return docs.where(clean(F.coalesce(F.col("text").cast("string"), F.lit(""))))
