"""Jaccard self-join of word-shingle sets by chosen paths.

Sets are embedded as ``SIGNATURE`` minwise tokens (coordinate, value). A run splits
all sets recursively: a node of the tree chooses ``branches`` coordinates from a hash
of its path, and the sets that share the value of a chosen coordinate meet in a
child. Small buckets are compared by brute force; large ones are split again. A
set of a large bucket that resembles most of a random part of it (the pivots) is
joined to these and not split further, as splitting never separates near copies.
Runs are repeated until a pair at the threshold is missed with a chance below
``1 - recall``. (After Christiani, Pagh and Sivertsen, "Scalable and Robust Set
Similarity Join".)

What the tree finds are candidates; they only decide which sets are compared
exactly. Candidates are gathered into connected components, every component is
dealt into blocks of at most about ``BLOCK_SETS`` sets and ``BLOCK_SHINGLES`` shingles, and all
pairs of a component are verified on their whole shingle sets inside the tasks, ``BLOCK`` sets by
``BLOCK`` at a time. Links are counted and grouped there, so no list of pairs is ever
written. A text is fetched once and goes to as many tasks as its component has blocks.

Distinct sets are numbered, so an id that several different texts share is as many sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import components, least_labels
from quarry.llm.textops import mix, slices, text_buffers, word_shingles, words
from quarry.session import ensure_checkpoint_dir

SIGNATURE = 128
_rng = np.random.default_rng(20240229)
_MULT = _rng.integers(1, 1 << 62, SIGNATURE).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 62, SIGNATURE).astype(np.uint64)

BLOCK = 128
BLOCK_SETS = 4096
BLOCK_SHINGLES = 1 << 20
PIVOTS = 32


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minwise values of a non-empty shingle set."""
    low = np.full(SIGNATURE, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingles), 2048):
        part = shingles[a:a + 2048]
        np.minimum(low, (part[None, :] * _MULT[:, None] + _ADD[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def needed_runs(threshold: float, branches: int, recall: float, depth: int) -> int:
    """Runs after which a pair at ``threshold`` was together at ``depth`` with a chance of ``recall``."""
    q = 1.0
    for _ in range(depth):
        q = 1 - (1 - threshold * q) ** branches
    return 1 if q >= recall else math.ceil(math.log(1 - recall) / math.log(1 - q))


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, th, d1, d2, n, sig``: hash of the text, and digest, size and signature of the shingle set of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            n = np.zeros(batch.num_rows, np.int64)
            d1, d2 = n.copy(), n.copy()
            sig: list[bytes | None] = [None] * batch.num_rows
            for a, b in slices(offsets):
                hashes, before = words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                for k, own in enumerate(word_shingles(hashes, before, size), a):
                    if len(own):
                        n[k] = len(own)
                        d1[k] = mix(own).sum().view(np.int64)
                        d2[k] = mix(own ^ np.uint64(0x5DEECE66D)).sum().view(np.int64)
                        sig[k] = signature(own).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(d1), pa.array(d2), pa.array(n), pa.array(sig, pa.binary())],
                names=["doc_id", "th", "d1", "d2", "n", "sig"])

    return _texts(docs).mapInArrow(run, "doc_id long, th long, d1 long, d2 long, n long, sig binary")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text", "xxhash64(cast(text as string)) as th")


def _children(path: np.ndarray, sig: np.ndarray, branches: int) -> np.ndarray:
    """(len(path), branches) child paths; a node's coordinates depend on its path only."""
    coordinate = mix(path[:, None] + np.arange(SIGNATURE, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B1))
    chosen = np.argpartition(coordinate, branches - 1, axis=1)[:, :branches]
    value = np.take_along_axis(sig, chosen, axis=1).astype(np.uint64)
    return mix(mix(path[:, None] ^ (chosen.astype(np.uint64) << np.uint64(40))) + value)


def _first_level(reps: DataFrame, runs: int, branches: int) -> DataFrame:
    roots = mix(np.arange(runs, dtype=np.uint64) + np.uint64(977))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, SIGNATURE)
            rep = np.asarray(batch.column(0))
            for root in roots:
                paths = _children(np.full(len(rep), root), sig, branches)
                yield pa.RecordBatch.from_arrays([pa.array(paths.ravel().view(np.int64)), pa.array(np.repeat(rep, branches))],
                                                 names=["path", "rep"])

    return reps.select("rep", "sig").mapInArrow(run, "path long, rep long")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[pa.Array]]:
    """The rows of each run of equal first ``keys`` columns (sorted input), column by column."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([np.asarray(batch.column(k)) for k in range(keys)], axis=1)
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = tuple(key[a].tolist())
            if held and own != last:
                yield _joined(held)
                held = []
            last = own
            held.append(batch.slice(a, b - a))
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> list[pa.Array]:
    if len(parts) == 1:
        return list(parts[0].columns)
    return [c.combine_chunks() for c in pa.Table.from_batches(parts).columns]


def _resolve(dealt: DataFrame, cut: float, dense: float, reach: float, branches: int) -> DataFrame:
    """Compare the dealt buckets: candidate edges (``path`` null) and the next level's rows.

    Estimated similarities: ``cut`` makes a candidate, ``dense`` to half of the pivots
    settles a set, ``reach`` to a pivot of a bucket with settled sets makes a candidate.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_out: list[np.ndarray] = []
        b_out: list[np.ndarray] = []
        next_rows: list[pa.RecordBatch] = []
        names = ["path", "rep", "other", "sig"]

        def edges() -> pa.RecordBatch:
            a, b = np.concatenate(a_out), np.concatenate(b_out)
            a_out.clear()
            b_out.clear()
            return pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()), pa.array(a), pa.array(b), pa.nulls(len(a), pa.binary())], names=names)

        for group in _groups(batches, 2):
            path, role, rep = np.asarray(group[0]), np.asarray(group[2]), np.asarray(group[3])
            sig = np.frombuffer(b"".join(group[4].to_pylist()), np.uint32).reshape(-1, SIGNATURE)
            pivots = role == 1
            if not pivots.any():
                same = np.empty((len(rep), len(rep)), np.float32)
                for a in range(0, len(rep), 32):
                    same[a:a + 32] = (sig[a:a + 32, None, :] == sig[None, :, :]).mean(axis=2)
                i, j = np.nonzero(np.triu(same >= cut, 1))
                if len(i):
                    label = least_labels(len(rep), i, j)
                    own = np.flatnonzero(label != np.arange(len(rep)))
                    a_out.append(rep[own])
                    b_out.append(rep[label[own]])
            else:
                ps, pr = sig[pivots], rep[pivots]
                ms, mr, mp = sig[~pivots], rep[~pivots], path[~pivots].view(np.uint64)
                near = np.empty((len(mr), len(pr)), np.float32)
                for a in range(0, len(mr), 64):
                    near[a:a + 64] = (ms[a:a + 64, None, :] == ps[None, :, :]).mean(axis=2)
                between = (ps[:, None, :] == ps[None, :, :]).mean(axis=2)
                crowded = ((between >= dense).mean(axis=0) >= 0.5).any()  # some pivot resembles most pivots
                settled = crowded & ((near >= dense).mean(axis=1) >= 0.5)
                # What is as near as the threshold to a settled set is within ``reach`` of the
                # same pivots (Jaccard distance is a metric), so settling loses no pair.
                i, j = np.nonzero((near >= (reach if crowded else cut)) & (mr[:, None] != pr[None, :]))
                # One edge a set, to the least member of its part of this group.
                every = np.r_[mr, pr]
                label = least_labels(len(every), i, j + len(mr))
                own = np.flatnonzero(every != every[label])
                a_out.append(every[own])
                b_out.append(every[label[own]])
                go = np.flatnonzero(~settled)
                if len(go):
                    paths = _children(mp[go], ms[go], branches)
                    again = pa.array([x.tobytes() for x in ms[go]], pa.binary())
                    for k in range(branches):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(paths[:, k].view(np.int64)), pa.array(mr[go]), pa.nulls(len(go), pa.int64()), again], names=names)
            if sum(map(len, a_out)) > 20_000:
                yield edges()
        if a_out:
            yield edges()

    sorted_rows = dealt.repartition("path", "part").sortWithinPartitions("path", "part")
    return sorted_rows.select("path", "part", "role", "rep", "sig").mapInArrow(run, "path long, rep long, other long, sig binary")


def _deal(rows: DataFrame, limit: int, last: bool) -> DataFrame:
    """``path, part, role, rep, sig`` from rows with their bucket's size ``n`` (2 or more)."""
    parts = F.ceil(F.col("n") / (2 * BLOCK)).cast("int")
    zero = F.lit(0).cast("bigint")
    small = rows.where(F.col("n") <= limit).select("path", zero.alias("part"), F.lit(0).alias("role"), "rep", "sig")
    big = rows.where(F.col("n") > limit).withColumn("parts", parts)
    if last:  # no further split: all pairs of blocks
        own = F.pmod(F.xxhash64("rep"), F.col("parts"))
        other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts").cast("bigint") - 1))
        pairs = big.select("path", "parts", "rep", "sig", own.alias("own"), other.alias("other")).select(
            "path", (F.least("own", "other") * F.col("parts") + F.greatest("own", "other")).alias("part"),
            F.lit(0).alias("role"), "rep", "sig")
        return small.unionByName(pairs)
    members = big.select("path", F.pmod(F.xxhash64("rep"), F.col("parts")).alias("part"), F.lit(0).alias("role"), "rep", "sig")
    # A random part of about PIVOTS members, the same for every run: those with a small hash of path and id.
    drawn = F.pmod(F.xxhash64("rep", "path"), F.col("n")) < PIVOTS
    pivots = big.where(drawn).select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts").cast("bigint") - 1)).alias("part"),
                                     F.lit(1).alias("role"), "rep", "sig")
    return small.unionByName(members).unionByName(pivots)


def candidates(reps: DataFrame, threshold: float, recall: float, branches: int = 2, limit: int = 64, depth: int = 6,
               slack: float = 0.18, dense: float = 0.5) -> DataFrame:
    """Candidate edges ``a, b`` between the sets ``reps(rep, sig)``; they connect all similar pairs.

    ``slack`` is how far below the threshold an estimate from signatures may lie (five
    standard deviations of ``SIGNATURE`` coordinates). A set that has the similarity
    ``dense`` to half of a large bucket's pivots is not split further.
    """
    reach = dense - (1 - threshold) - 0.08  # two deviations; it must fail for all near pivots to matter
    runs = needed_runs(threshold, branches, recall, depth)
    rows = _first_level(reps, runs, branches)
    found = None
    for level in range(depth):
        sizes = rows.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        rows = rows.join(sizes, "path")
        if "sig" not in rows.columns:
            rows = rows.join(reps.select("rep", "sig"), "rep")
        got = _resolve(_deal(rows, limit, level == depth - 1), threshold - slack, dense, reach, branches).checkpoint()
        edges = got.where("path is null").select(F.col("rep").alias("a"), F.col("other").alias("b"))
        found = edges if found is None else found.unionByName(edges)
        rows = got.where("path is not null").select("path", "rep", "sig")
        if level == depth - 1 or rows.isEmpty():
            break
    return found


def linked(sets: list[np.ndarray], others: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of ``sets`` (rows) and ``others`` (columns), all non-empty, have the wanted Jaccard similarity."""
    na, nb = np.array([len(s) for s in sets], np.int64), np.array([len(s) for s in others], np.int64)
    shared = np.zeros((len(na), len(nb)), np.float32)
    if len(na) * len(nb) <= 16:
        for i, s in enumerate(sets):
            for j, o in enumerate(others):
                shared[i, j] = len(np.intersect1d(s, o, assume_unique=True))
    else:
        # Products of 0/1 matrices over the shingles both sides have, some columns at a time.
        flat, flat_o = np.concatenate(sets), np.concatenate(others)
        common = np.intersect1d(flat, flat_o)
        row, row_o = np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)

        def placed(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = np.minimum(np.searchsorted(common, values), max(0, len(common) - 1))
            ok = common[at] == values if len(common) else np.zeros(len(values), bool)
            order = np.argsort(at[ok], kind="stable")
            return at[ok][order], rows[ok][order]

        at, row = placed(flat, row)
        at_o, row_o = placed(flat_o, row_o)
        for c in range(0, len(common), 4096):
            a, a_o = np.zeros((len(na), 4096), np.float32), np.zeros((len(nb), 4096), np.float32)
            lo, hi = np.searchsorted(at, [c, c + 4096])
            a[row[lo:hi], at[lo:hi] - c] = 1
            lo, hi = np.searchsorted(at_o, [c, c + 4096])
            a_o[row_o[lo:hi], at_o[lo:hi] - c] = 1
            shared += a @ a_o.T
    union = na[:, None] + nb[None, :] - shared
    return shared >= threshold * union - 1e-6


def _compared(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(links of each of ``sets``, least set of its chain of links) between the sets numbered ``first`` and ``second``.

    The two are equal or disjoint. Sets meet by size, so that parts too unlike in size are passed over.
    """
    links, label_edges = np.zeros(len(sets), np.int64), ([], [])
    sizes = np.array([len(x) for x in sets], np.int64)
    within = first is second

    def parts(own: np.ndarray) -> list[np.ndarray]:
        own = own[np.argsort(sizes[own], kind="stable")]
        return [own[a:a + BLOCK] for a in range(0, len(own), BLOCK)]

    left = parts(first)
    right = left if within else parts(second)
    for x, a in enumerate(left):
        for b in right[x:] if within else right:
            if sizes[a[-1]] < threshold * sizes[b[0]] - 1e-6 or sizes[b[-1]] < threshold * sizes[a[0]] - 1e-6:
                continue
            hit = linked([sets[i] for i in a], [sets[i] for i in b], threshold)
            if a is b:
                np.fill_diagonal(hit, False)
            links[a] += hit.sum(axis=1)
            if a is not b:
                links[b] += hit.sum(axis=0)
            i, j = np.nonzero(hit)
            if len(i):
                every = np.r_[a, b]
                label = least_labels(len(every), i, j + len(a))
                if a is b:  # both halves are the same sets
                    label = least_labels(len(a), i, j)
                    every = a
                label_edges[0].append(every)
                label_edges[1].append(every[label])
    if not label_edges[0]:
        return links, np.arange(len(sets))
    return links, least_labels(len(sets), np.concatenate(label_edges[0]), np.concatenate(label_edges[1]))


def _verify(grouped: DataFrame, threshold: float, size: int) -> DataFrame:
    """From ``root, pair, block, rep, text`` rows: ``rep, links, other``.

    A row has a number of links found in one block pair, or a star edge to ``other``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 2):
            block, rep = np.asarray(group[2]), np.asarray(group[3])
            data, offsets = text_buffers(group[4])
            sets: list[np.ndarray] = []
            for a, b in slices(offsets):
                hashes, before = words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                sets.extend(word_shingles(hashes, before, size))
            first = np.flatnonzero(block == block.min())
            second = first if len(first) == len(block) else np.flatnonzero(block == block.max())
            links, label = _compared(sets, first, second, threshold)
            own = np.flatnonzero(links > 0)
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(rep[own]), pa.array(links[own]), pa.array(rep[label[own]])],
                                                 names=["rep", "links", "other"])

    return grouped.repartition("root", "pair").sortWithinPartitions("root", "pair").select(
        "root", "pair", "block", "rep", "text").mapInArrow(run, "rep long, links long, other long")


def _classes(docs: DataFrame, threshold: float, size: int, recall: float) -> DataFrame:
    """The columns of :func:`jaccard_join` and ``th``, the hash of the row's text."""
    ensure_checkpoint_dir(docs.sparkSession)
    sets = _sets(docs, size).checkpoint()
    known = sets.where("doc_id is not null and n > 0")
    reps = known.groupBy("d1", "d2", "n").agg(F.min(F.struct("doc_id", "th", "sig")).alias("x"), F.count("*").alias("copies")).select(
        F.monotonically_increasing_id().alias("rep"), "d1", "d2", "n", "copies", "x.*").checkpoint()
    near = components(candidates(reps.select("rep", "sig"), threshold, recall))

    dealt = near.join(reps.select(F.col("rep").alias("node"), "doc_id", "th", "n"), "node")
    sizes = dealt.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("bigint").alias("blocks"))
    dealt = dealt.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).drop("n")
    # A block meets every block of its component once: pairs (i, j) with i <= j.
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    paired = _texts(docs).join(dealt, ["doc_id", "th"]).dropDuplicates(["doc_id", "th", "node"]).withColumn("other", other)
    pair = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    grouped = paired.select("root", pair.alias("pair"), "block", F.col("node").alias("rep"), "text")
    verified = _verify(grouped, threshold, size).checkpoint()
    links = verified.groupBy("rep").agg(F.sum("links").alias("n_links"))
    joined = components(verified.select(F.col("rep").alias("a"), F.col("other").alias("b"))).select(F.col("node").alias("rep"), "root")
    joined = joined.join(reps.select("rep", "doc_id"), "rep")
    least = joined.groupBy("root").agg(F.min("doc_id").alias("class"))
    joined = joined.join(least, "root").select("rep", "class")

    per_set = reps.select("rep", "d1", "d2", "n", "copies", F.col("doc_id").alias("rep_id")).join(links, "rep", "left").join(joined, "rep", "left")
    rows = known.select("doc_id", "th", "d1", "d2", "n").join(per_set, ["d1", "d2", "n"])
    zero = F.lit(0).cast("bigint")
    out = rows.select("doc_id", F.coalesce("class", "rep_id").alias("class_id"), F.coalesce("n_links", zero).alias("n_links"),
                      "rep_id", F.col("copies").alias("n_copies"), "th")
    alone = sets.where("doc_id is null or n = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), zero.alias("n_links"), F.col("doc_id").alias("rep_id"),
        F.lit(1).cast("bigint").alias("n_copies"), "th")
    return out.unionByName(alone)


def jaccard_join(docs: DataFrame, threshold: float = 0.8, size: int = 5, recall: float = 0.99999) -> DataFrame:
    """``doc_id, class_id, n_links, rep_id, n_copies`` for each row of ``docs(doc_id, text)``.

    Rows with equal shingle sets are copies of ``rep_id``, the least id among them, and
    ``n_copies`` in number. ``n_links`` counts the other distinct sets that have a
    Jaccard similarity of ``threshold`` or more; ``class_id`` is the least id of a row
    that a chain of links reaches. A text of fewer than ``size`` words, but not none, is one
    shingle. A text without words (also null or empty) is like nothing and forms a
    class of its own. Rows with a null id are compared with none: their class is null.
    Repeated rows each give a row; rows that share an id but not a text are told apart. Other columns
    are ignored. An empty table gives no rows.
    """
    return _classes(docs, threshold, size, recall).drop("th")


def keep_one(docs: DataFrame, threshold: float = 0.8, size: int = 5, recall: float = 0.99999) -> DataFrame:
    """The rows of ``docs`` whose id is the least of their class, whole.

    Rows with a null id stay. Rows that share an id but not a text are decided each by its text; repeated rows
    stay or go together. An empty table stays empty.
    """
    found = _classes(docs, threshold, size, recall).where("doc_id = class_id").select(
        F.col("doc_id").alias("_keep"), F.col("th").alias("_text")).distinct()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_keep"), F.expr("xxhash64(cast(text as string))").alias("_text"),
                       F.struct("*").alias("_row"))
    return rows.join(found, ["_keep", "_text"], "left_semi").select("_row.*").unionByName(docs.where("doc_id is null"))
