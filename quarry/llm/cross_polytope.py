"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation is three rounds of random signs and a fast Hadamard transform; a
unit vector's digit is the signed axis nearest to its rotated form, and a bucket
of a table is a sequence of digits. A query probes every bucket whose loss (the squared
shortfall of the bucket's axes against the nearest ones, summed over the
digits) is at most a radius. (After Andoni et al., "Practical and Optimal LSH for
Angular Distance".)

The index is fitted on a bounded sample: the radius is the least that finds the wanted
share of the true neighbours of ``SAMPLE`` queries, which are compared with all rows.
Every row is indexed. Rows meet the queries of their bucket's first digit in a task
that keeps to the probed buckets by the other digits and reranks on the original
vectors, in blocks; only the nearest leave it. A first digit of more
than ``group_rows`` rows is dealt into parts, and its queries go to each part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.textops import mix
from quarry.session import ensure_checkpoint_dir

SAMPLE = 64
ROUNDS = 3
_PAIRS = 1 << 22  # distances held at a time


def rotated(unit: np.ndarray, seed: int) -> np.ndarray:
    """A pseudo-rotation of the rows of ``unit``, padded to a power of two."""
    n, dims = unit.shape
    size = 1 << max(0, dims - 1).bit_length()
    out = np.zeros((n, size))
    out[:, :dims] = unit
    rng = np.random.default_rng([seed, dims])
    for _ in range(ROUNDS):
        out *= rng.choice([-1.0, 1.0], size)
        half = 1
        while half < size:
            pair = out.reshape(n, -1, 2, half)
            out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, size)
            half *= 2
        out /= math.sqrt(size)
    return out


def nearest_axis(turned: np.ndarray) -> np.ndarray:
    """Number of the nearest signed axis: twice the axis, and one if negative."""
    axis = np.abs(turned).argmax(axis=1)
    return 2 * axis + (turned[np.arange(len(turned)), axis] < 0)


def losses(turned: np.ndarray) -> np.ndarray:
    """(rows, signed axes): squared shortfall of each axis against the nearest."""
    along = np.stack([turned, -turned], axis=2).reshape(len(turned), -1)
    return (along.max(axis=1, keepdims=True) - along) ** 2


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _seed(table: int, digit: int) -> int:
    return 1000 * table + digit


def digits_for(rows: int, dims: int, bucket_rows: int) -> int:
    """Digits after which ``rows`` make buckets of about ``bucket_rows``; one at least."""
    axes = 2 << max(0, dims - 1).bit_length()
    return max(1, math.ceil(math.log(max(2.0, rows / bucket_rows)) / math.log(axes)))


def valid_vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors of one length) of the valid rows of ``id, vector`` batches, a length at a time.

    Rows without an id, null, empty or zero vectors and those with null or non-finite components are left out.
    """
    ids, column = batch.column(0), batch.column(1)
    ok = ~np.asarray(ids.is_null()) & ~np.asarray(column.is_null())
    ends = column.offsets.to_numpy().astype(np.int64)
    values = column.values
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    sizes = np.diff(ends)
    known = ids.fill_null(0).to_numpy()
    for size in np.unique(sizes[ok]).tolist():
        if not size:
            continue
        own = np.flatnonzero(ok & (sizes == size))
        vectors = flat[ends[own][:, None] + np.arange(size)]
        good = np.isfinite(vectors).all(axis=1) & (vectors != 0).any(axis=1)
        if good.any():
            yield known[own[good]], vectors[good]


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows."""
    return np.sqrt(((queries - rows) ** 2).sum(axis=1))


def nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int,
            allowed=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, row number, distance) of each query's ``k`` nearest rows, other than those of its id.

    ``allowed(a, b)`` is the mask of rows that queries ``a`` to ``b`` may take. Ties go to the
    smaller id; the rows of one id count once for each distinct distance.
    """
    got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if not len(rows):
        queries = queries[:0]
    deep = k + len(ids) - len(np.unique(ids))  # rows of one id may count once
    row_norm = (rows ** 2).sum(axis=1)
    step = max(1, _PAIRS // max(1, len(rows)))
    for a in range(0, len(queries), step):
        block = queries[a:a + step]
        own_norm = (block ** 2).sum(axis=1)
        with np.errstate(over="ignore", invalid="ignore"):
            square = own_norm[:, None] + row_norm[None, :] - 2 * (block @ rows.T)
        # How far a square by products may be off; beyond the range of doubles all rows are compared.
        slack = 1e-12 * (own_norm[:, None] + row_norm.max()) * max(8, rows.shape[1])
        square[~np.isfinite(square)] = 0.0
        out = query_ids[a:a + step, None] == ids[None, :]
        if allowed is not None:
            out |= ~allowed(a, a + len(block))
        square[out] = np.inf
        if len(rows) > deep:
            cut = np.partition(square, deep - 1, axis=1)[:, deep - 1:deep] + 2 * slack
        else:
            cut = np.full((len(block), 1), np.inf)
        i, j = np.nonzero((square <= cut) & ~out)
        distance = _exact(block[i], rows[j])
        order = np.lexsort((ids[j], distance, i))
        i, j, distance = i[order], j[order], distance[order]
        new = np.r_[True, (i[1:] != i[:-1]) | (ids[j][1:] != ids[j][:-1]) | (distance[1:] != distance[:-1])][:len(i)]
        i, j, distance = i[new], j[new], distance[new]
        first = np.searchsorted(i, i)
        keep = np.arange(len(i)) - first < k
        got.append((i[keep] + a, j[keep], distance[keep]))
    if not got:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0)
    return tuple(np.concatenate(part) for part in zip(*got, strict=True))


def _packed(vectors: np.ndarray) -> list[bytes]:
    """Vectors as bytes, with single precision where that loses nothing (a first byte tells)."""
    with np.errstate(over="ignore"):
        single = vectors.astype("<f4")
    short = (single == vectors).all(axis=1)
    return [b"\x04" + s.tobytes() if ok else b"\x08" + v.astype("<f8").tobytes()
            for ok, s, v in zip(short, single, vectors, strict=True)]


def _unpacked(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(v, "<f4" if v[0] == 4 else "<f8", offset=1) for v in column.to_pylist()], np.float64)


def _survey(table: DataFrame, sample: list, tables: int, k: int) -> tuple[dict[int, int], dict, dict]:
    """One pass over all rows: rows of each length, rows of each first digit, the sample's true neighbours."""
    asked = {}
    for size in {len(r["vector"]) for r in sample}:
        own = [r for r in sample if len(r["vector"]) == size]
        asked[size] = (np.array([r["id"] for r in own]), np.array([r["vector"] for r in own], np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int, int], int] = {}
        best: dict[int, list] = {}
        for batch in batches:
            for ids, vectors in valid_vectors(batch):
                size = vectors.shape[1]
                counts[size, -1, -1] = counts.get((size, -1, -1), 0) + len(ids)
                unit = units(vectors)
                for t in range(tables):
                    digit, n = np.unique(nearest_axis(rotated(unit, _seed(t, 0))), return_counts=True)
                    for d, c in zip(digit.tolist(), n.tolist(), strict=True):
                        counts[size, t, d] = counts.get((size, t, d), 0) + c
                if size in asked:
                    held_ids, held = best.get(size, (np.zeros(0, np.int64), np.zeros((0, size))))
                    every_ids, every = np.r_[held_ids, ids], np.r_[held, vectors]
                    keep = np.unique(nearest(*asked[size], every_ids, every, k)[1])
                    best[size] = every_ids[keep], every[keep]
        keys = list(counts)
        if keys:
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([key[c] for key in keys], pa.int64()) for c in range(3)), pa.array(list(counts.values()), pa.int64()),
                 pa.nulls(n, pa.binary())], names=["size", "t", "digit", "n", "vec"])
        for size, (ids, vectors) in best.items():
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, size)), pa.array(np.full(n, -2)), pa.array(np.full(n, -2)), pa.array(ids),
                 pa.array(_packed(vectors), pa.binary())], names=["size", "t", "digit", "n", "vec"])

    seen = table.mapInArrow(run, "size long, t long, digit long, n long, vec binary").checkpoint()
    counts = seen.where("t > -2").groupBy("size", "t", "digit").agg(F.sum("n").alias("n"))
    lengths = {r["size"]: r["n"] for r in counts.where("t = -1").collect()}
    groups = counts.where("t >= 0")
    near = {}
    for size, (query_ids, queries) in asked.items():
        # At most SAMPLE * k rows a task; the nearest of them are taken a task at a time.
        ids, rows = np.zeros(0, np.int64), np.zeros((0, size))
        for r in seen.where(F.col("t") == -2).where(F.col("size") == size).select("n", "vec").toLocalIterator():
            ids, rows = np.r_[ids, r["n"]], np.r_[rows, _unpacked(pa.array([bytes(r["vec"])]))]
            if len(ids) > 4 * SAMPLE * k:
                keep = np.unique(nearest(query_ids, queries, ids, rows, k)[1])
                ids, rows = ids[keep], rows[keep]
        i, j, _ = nearest(query_ids, queries, ids, rows, k)
        near[size] = queries[i], rows[j]
    return lengths, groups, near


def _radius(pairs: tuple[np.ndarray, np.ndarray], tables: int, digits: int, recall: float) -> float:
    """Least radius at which one of the tables leads from ``recall`` of the queries' sides to the rows'."""
    queries, rows = pairs
    if not len(queries):
        return math.inf
    best = np.full(len(queries), np.inf)
    query_units, row_units = units(queries), units(rows)
    for t in range(tables):
        loss = np.zeros(len(queries))
        for d in range(digits):
            axis = nearest_axis(rotated(row_units, _seed(t, d)))
            loss += losses(rotated(query_units, _seed(t, d)))[np.arange(len(queries)), axis]
        best = np.minimum(best, loss)
    return float(np.sort(best)[min(len(best) - 1, math.ceil(recall * len(best)))]) + 1e-9


def _repeats(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Rows that may be among the nearest of any query: of equal vectors the ``k + 1`` smallest ids."""
    order = np.lexsort((ids, *vectors.T[::-1]))
    same = (vectors[order][1:] == vectors[order][:-1]).all(axis=1)
    new = np.r_[True, ~same | (ids[order][1:] != ids[order][:-1])]  # a repeated row counts once
    order = order[new]
    same = (vectors[order][1:] == vectors[order][:-1]).all(axis=1)
    start = np.r_[0, np.flatnonzero(~same) + 1]
    place = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
    return order[place <= k]


def _deal(table: DataFrame, every: int, k: int, tables: int, digits: dict[int, int], radius: dict[int, float],
          parts: dict[tuple[int, int, int], int]) -> DataFrame:
    """``size, t, digit, part, role, id, room, vec``: each row once a table, each query once a probed first digit and part."""
    names = ["size", "t", "digit", "part", "role", "id", "room", "vec"]

    def rows(size, t, digit, part, role, ids, room, vec) -> pa.RecordBatch:
        n = len(ids)
        full = lambda v, kind: pa.array(np.broadcast_to(np.asarray(v, kind), n).copy())
        return pa.RecordBatch.from_arrays(
            [full(size, np.int32), full(t, np.int32), full(digit, np.int32), full(part, np.int32), full(role, np.int32),
             full(ids, np.int64), full(room, np.float64), pa.array(vec, pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, vectors in valid_vectors(batch):
                size = vectors.shape[1]
                kept = _repeats(ids, vectors, k)
                asks = np.flatnonzero(ids % every == 0)
                unit, packed = units(vectors), np.array(_packed(vectors), object)
                for t in range(tables):
                    turned = rotated(unit, _seed(t, 0))
                    digit = nearest_axis(turned[kept])
                    split = np.array([parts.get((size, t, d), 1) for d in range(2 * turned.shape[1])], np.int64)
                    part = (mix(ids[kept].astype(np.uint64)) % split[digit].astype(np.uint64)).astype(np.int64)
                    yield rows(size, t, digit, part, 0, ids[kept], 0.0, packed[kept])
                    for a in range(0, len(asks), 64):
                        own = asks[a:a + 64]
                        room = radius.get(size, math.inf) - losses(turned[own])
                        q, d = np.nonzero(room >= 0)
                        again = np.repeat(np.arange(len(q)), split[d])
                        place = np.arange(len(again)) - np.repeat(np.cumsum(split[d]) - split[d], split[d])
                        q, d = q[again], d[again]
                        yield rows(size, t, d, place, 1, ids[own[q]], room[q, d], packed[own[q]])

    return table.mapInArrow(run, "size int, t int, digit int, part int, role int, id long, room double, vec binary")


def _everywhere(table: DataFrame, asked: DataFrame, lengths: dict[int, int], group_rows: int) -> DataFrame:
    """As :func:`_deal`, for the queries ``asked(id)`` against all rows in blocks: exact."""
    blocks = max(1, math.ceil(max(lengths.values(), default=1) / group_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, vectors in valid_vectors(batch):
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, vectors.shape[1], np.int32)), pa.array(ids), pa.array(_packed(vectors), pa.binary())],
                    names=["size", "id", "vec"])

    valid = table.mapInArrow(run, "size int, id long, vec binary")
    own = valid.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("role", F.lit(0))
    asks = valid.join(asked, "id", "left_semi").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn(
        "role", F.lit(1))
    return own.unionByName(asks).select("size", F.lit(0).alias("t"), F.lit(0).alias("digit"), "part", "role", "id",
                                        F.lit(float("inf")).alias("room"), "vec")


def _compare(dealt: DataFrame, k: int, digits: dict[int, int]) -> DataFrame:
    """``query_id, vec_id, score``: the nearest rows a query found in each dealt group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ids, vectors = None, [], []
        rows = masks = None
        for batch in batches:
            keys = np.stack([np.asarray(batch.column(c)) for c in range(5)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                *group, role = keys[a].tolist()
                if group != last:
                    last, ids, vectors, rows = group, [], [], None
                own_ids, own = np.asarray(batch.column(5))[a:b], _unpacked(batch.column(7).slice(a, b - a))
                if role == 0:
                    ids.append(own_ids)
                    vectors.append(own)
                    continue
                if not ids:
                    continue  # no row has this digit
                size, t = group[:2]
                room = np.asarray(batch.column(6))[a:b]
                if rows is None:
                    rows = np.concatenate(vectors)
                    row_ids = np.concatenate(ids)
                    row_units = units(rows)
                    masks = [nearest_axis(rotated(row_units, _seed(t, d))) for d in range(1, digits.get(size, 1))]
                query_units = units(own)
                further = [losses(rotated(query_units, _seed(t, d))) for d in range(1, digits.get(size, 1))]

                def probed(x: int, y: int, room=room, further=further, masks=masks) -> np.ndarray:
                    loss = np.zeros((y - x, len(rows)))
                    for own_loss, axis in zip(further, masks, strict=True):
                        loss += own_loss[x:y][:, axis]
                    return loss <= room[x:y, None]

                i, j, distance = nearest(own_ids, own, row_ids, rows, k, probed)
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(own_ids[i]), pa.array(row_ids[j]), pa.array(distance)],
                                                     names=["query_id", "vec_id", "score"])

    keys = ["size", "t", "digit", "part"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "role", "id").select(
        *keys, "role", "id", "room", "vec").mapInArrow(run, "query_id long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """Each query's ``k`` nearest of ``found``; a pair found in several tables counts once."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k).dropDuplicates(["query_id", "rank"])


def nearest_neighbours(vectors: DataFrame, every: int = 100, k: int = 10, tables: int = 2, recall: float = 0.96,
                       bucket_rows: int = 64, group_rows: int = 1 << 18, id_col: str = "vec_id",
                       vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of each row whose id is divisible by ``every``.

    ``score`` is the Euclidean distance of the original vectors in double precision, ranked
    from 1, ties to the smaller id. Candidates are all rows but those of the query's id, of
    the query's length. Rows without an id, and null, empty or zero vectors and those with
    null or non-finite components take no part. Repeated rows count once. A query that
    finds fewer than ``k`` candidates in its buckets is compared with all rows. ``recall``
    is what the radius is fitted to. Other columns are ignored.
    """
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    table = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                           F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    sound = ("vector is not null and size(vector) > 0 and exists(vector, x -> x <> 0) and "
             "forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    sample = (table.where(F.col("id") % every == 0).where(sound)
              .orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect())
    lengths, groups, near = _survey(table, sample, tables, k)
    digits = {size: digits_for(n, size, bucket_rows) for size, n in lengths.items()}
    radius = {size: _radius(pairs, tables, digits[size], recall) for size, pairs in near.items()}
    # Only groups beyond ``group_rows`` come to the driver: at most a table's rows over ``group_rows`` of them a table.
    large = groups.where(F.col("n") > group_rows).collect()
    parts = {(r["size"], r["t"], r["digit"]): math.ceil(r["n"] / group_rows) for r in large}
    found = _best(_compare(_deal(table, every, k, tables, digits, radius, parts), k, digits), k).checkpoint()
    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    asked = table.where(F.col("id") % every == 0).where(sound).select("id").distinct()
    short = asked.join(enough.select(F.col("query_id").alias("id")), "id", "left_anti").checkpoint()
    if short.take(1):
        rest = _compare(_everywhere(table, short, lengths, group_rows), k, {})
        ends = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti")
        found = ends.unionByName(_best(rest, k))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
