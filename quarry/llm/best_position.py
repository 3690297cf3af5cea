"""Ranked lexical search by the Best Position Algorithm.

Documents are dealt into shards of bounded size. A shard keeps, for each term, its
impact list (the documents by falling share of the score) and the same documents by
number for direct access. An item reads its terms' lists in parallel; every
document read is looked up in the other lists, and all positions met either way are marked
as seen. A list's best position is the end of its unbroken run of seen positions; no
unseen document can have more than the sum of the lists' values there. Reading stops when
that sum is strictly below the k-th score, so documents that tie with it are all
found. (After Akbarinia, Pacitti and Valduriez, "Best Position Algorithms for Top-k
Queries".)

Documents carry only terms that a fixed-size bit table of the items' terms lets
through, compared as strings in the shard; the best of all shards are ranked in Spark.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.terms import byte_table, counted, numbered_terms
from quarry.llm.textops import mix, text_buffers, words
from quarry.session import ensure_checkpoint_dir

_TABLE = byte_table(digits=True)
BITS = 1 << 23
# Fixed values of the contract's score.
SCALE, LENGTH_SHARE, LENGTH_WEIGHT = 1_000_000_000, 90, 8


def _bit(terms: pa.Array) -> np.ndarray:
    """Place in the bit table of each term; the empty string, which is no term, has any."""
    hashes, before = words(*text_buffers(terms.cast(pa.large_string())))  # a term is one word
    return (mix(np.append(hashes, np.uint64(0))[before[:-1]]) & np.uint64(BITS - 1)).astype(np.int64)


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, terms``: the distinct terms of each item's texts, space-joined; rows of one id are one item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, numbers, terms = numbered_terms(batch.column(1), _TABLE)
            row, number, _ = counted(rows, numbers, len(terms))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), terms.take(pa.array(number)).cast(pa.string()),
                                              pa.array(_bit(terms)[number])], names=["item_id", "term", "bit"])

    return items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "item_id long, term string, bit long").distinct()


def _bit_table(terms: DataFrame) -> np.ndarray:
    """Which of ``BITS`` places the items' terms have: at most 256 bitmaps of 4 kB, whatever the number of items."""
    # Spark numbers bits from 1.
    maps = terms.groupBy(F.expr("bitmap_bucket_number(bit + 1)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(bit + 1))").alias("bits")).collect()
    out = np.zeros(BITS, bool)
    for r in maps:
        bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
        out[(r["bucket"] - 1) * 32768 + np.flatnonzero(bits)] = True
    return out


def _postings(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """``doc_id, spread, length, terms, tf`` for each row, and the rows' document counts (``spread`` null: term, df).

    ``terms`` are space-joined, ``tf`` their numbers as 32-bit integers; only terms that ``known`` lets through.
    """
    names = ["doc_id", "spread", "length", "terms", "tf"]
    packed = np.packbits(known).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        table = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        seen = 0
        for batch in batches:
            rows, numbers, terms = numbered_terms(batch.column(1), _TABLE)
            length = np.bincount(rows, minlength=batch.num_rows).astype(np.int64)
            wanted = table[_bit(terms)]
            held = wanted[numbers] if len(numbers) else np.zeros(0, bool)
            row, number, n = counted(rows[held], numbers[held], len(terms))
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            own = pa.ListArray.from_arrays(pa.array(ends), terms.take(pa.array(number)).cast(pa.string()))
            flat = np.minimum(n, np.iinfo(np.int32).max).astype("<i4").tobytes()
            tf = [flat[4 * a:4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            spread = (seen + np.arange(batch.num_rows)) // 64 + (task << 40)
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(mix(spread.astype(np.uint64)).view(np.int64)), pa.array(length),
                 pc.binary_join(own, " ").cast(pa.string()), pa.array(tf, pa.binary())], names=names)
            if len(number):
                df = np.bincount(number, minlength=len(terms)).astype(np.int64)
                some = np.flatnonzero(df)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.int64()), pa.array(df[some]),
                     terms.take(pa.array(some)).cast(pa.string()), pa.nulls(len(some), pa.binary())], names=names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, spread long, length long, terms string, tf binary")


class Shard:
    """Impact lists of some documents, and the search over them."""

    def __init__(self, doc_ids: np.ndarray, lengths: np.ndarray, terms: list[str], tfs: list[bytes], n_docs: int, n_terms: int) -> None:
        # Documents are numbered by id, so that a smaller number wins a tie; null ids come last.
        order = np.argsort(doc_ids, kind="stable")
        self.doc_ids = doc_ids[order]
        text = pa.array([terms[k] for k in order.tolist()], pa.large_string())
        cut = pc.ascii_split_whitespace(text)
        ends = cut.offsets.to_numpy()
        sizes = np.array([len(tfs[k]) // 4 for k in order.tolist()], np.int64)
        doc = np.repeat(np.arange(len(order)), sizes)
        tf = np.frombuffer(b"".join(tfs[k] for k in order.tolist()), "<i4").astype(np.int64)
        coded = cut.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
        number = coded.indices.to_numpy().astype(np.int64)
        if len(tf) < len(number):  # a document without kept terms is cut into one empty string
            number = number[np.repeat(sizes > 0, np.diff(ends))]
        length = lengths[order]
        m = 100 - LENGTH_SHARE + (LENGTH_SHARE * length * n_docs) // max(1, n_terms)
        share = (SCALE * tf) // (1000 * tf + LENGTH_WEIGHT * m[doc])
        self.number = {t: k for k, t in enumerate(coded.dictionary.to_pylist())}
        by = np.lexsort((doc, number))  # direct access: documents of a term by number
        self.begin = np.searchsorted(number[by], np.arange(len(self.number) + 1))
        self.doc, self.share = doc[by], share[by]
        self.cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _lists(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents' places by falling impact, position of each place) of term ``k``."""
        if k not in self.cache:
            a, b = self.begin[k], self.begin[k + 1]
            ranked = np.argsort(-self.share[a:b], kind="stable")
            position = np.empty(b - a, np.int64)
            position[ranked] = np.arange(b - a)
            self.cache[k] = ranked, position
        return self.cache[k]

    def search(self, terms: list[str], weights: list[int], k: int) -> tuple[list[tuple[int, int]], int]:
        """(``(document number, score)`` of the ``k`` best with a score above 0, positions read)."""
        lists = []
        for t, w in zip(terms, weights, strict=True):
            own = self.number.get(t)
            if own is not None and w > 0:
                a, b = self.begin[own], self.begin[own + 1]
                lists.append((self.doc[a:b], self.share[a:b], *self._lists(own), w, np.zeros(b - a + 1, bool)))
        best = [0] * len(lists)
        met = np.zeros(len(self.doc_ids), bool)
        top_docs, top_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step, read = 0, 4 * k, 0
        while lists:
            fresh = []
            for docs, _, ranked, _, _, seen in lists:
                part = ranked[depth:depth + step]
                if len(part):
                    seen[depth:depth + len(part)] = True
                    fresh.append(docs[part])
                    read += len(part)
            if not fresh:
                break
            new = np.unique(np.concatenate(fresh))
            new = new[~met[new]]
            met[new] = True
            score = np.zeros(len(new), np.int64)
            for docs, share, _, position, w, seen in lists:  # direct accesses
                place = np.searchsorted(docs, new)
                place[place == len(docs)] = 0
                hit = docs[place] == new
                score[hit] += w * share[place[hit]]
                seen[position[place[hit]]] = True
            limit = 0
            for i, (_, share, ranked, _, w, seen) in enumerate(lists):
                best[i] += int(np.argmin(seen[best[i]:]))  # the last entry is never seen
                if best[i] < len(ranked):
                    limit += w * int(share[ranked[best[i]]])
            top_docs, top_scores = np.r_[top_docs, new], np.r_[top_scores, score]
            keep = np.lexsort((top_docs, -top_scores))[:k]
            top_docs, top_scores = top_docs[keep], top_scores[keep]
            if len(top_docs) == k and limit < top_scores[-1]:
                break
            depth += step
            step *= 2
        return [(d, s) for d, s in zip(top_docs.tolist(), top_scores.tolist(), strict=True) if s > 0], read


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, shard_docs: int = 16_384) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of ``docs(doc_id, text)`` for each of ``items(item_id, text)``.

    Terms are runs of digits, ASCII letters and characters beyond ASCII, A-Z lower-cased; null
    texts have none. Only scores above 0 are returned, equal scores by ascending ``doc_id`` (null
    ids last). Each row of ``docs`` is a document, repeated rows too; rows of ``items`` with one id (or
    with none) are one item of all their terms. Empty tables give no rows. Other columns
    are ignored. ``shard_docs`` bounds a task's memory and does not change the result.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    wanted = item_terms(items).checkpoint()
    posted = _postings(docs, _bit_table(wanted)).checkpoint()
    rows = posted.where("spread is not null")
    n_docs, n_terms, n_rows = rows.agg(F.count(F.when(F.col("length") > 0, 1)), F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    df = posted.where("spread is null").groupBy(F.col("terms").alias("term")).agg(F.sum("length").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("bigint")
    shards = max(1, math.ceil(n_rows / shard_docs))
    weighted = wanted.join(df, "term").withColumn("w", weight).where("w > 0")
    asked = (weighted.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("term", "w"))).alias("t"))
             .select("item_id", F.array_join(F.transform("t", lambda x: x["term"]), " ").alias("terms"),
                     F.array_join(F.transform("t", lambda x: x["w"].cast("string")), " ").cast("binary").alias("tf"),
                     F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")))
    dealt = rows.where("length > 0").select(F.pmod("spread", F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("role"),
                                            F.col("doc_id").alias("id"), "length", "terms", "tf").unionByName(
        asked.select("shard", F.lit(1).alias("role"), F.col("item_id").alias("id"), F.lit(0).cast("bigint").alias("length"), "terms", "tf"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, shard = None, ([], [], [], []), None
        for batch in batches:
            out: list[tuple] = []
            for s, role, own, length, terms, tf in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if s != last:
                    last, held, shard = s, ([], [], [], []), None
                if role == 0:
                    for column, value in zip(held, (own, length, terms, tf), strict=True):
                        column.append(value)
                    continue
                if not held[0] and shard is None:
                    continue
                if shard is None:
                    ids = np.array([np.iinfo(np.int64).max if d is None else d for d in held[0]], np.int64)
                    shard = Shard(ids, np.array(held[1], np.int64), held[2], held[3], n_docs, n_terms)
                    real = np.array([d is not None for d in held[0]])[np.argsort(ids, kind="stable")]
                    held = ([], [], [], [])
                best, _ = shard.search(terms.split(" "), [int(w) for w in tf.decode().split(" ")], k)
                out += [(own, int(shard.doc_ids[d]) if real[d] else None, score) for d, score in best]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["item_id", "doc_id", "score"])

    found = dealt.repartition("shard").sortWithinPartitions("shard", "role").mapInArrow(run, "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
