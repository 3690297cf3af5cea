"""Source divergence audit over run-length columns.

A language's terms are a table of counts, one column a source. Terms with equal
counts in all sources are brought together (with their number), the rest are
ordered by their counts, and every column is run-length encoded. For two sources
the run boundaries are intersected, and the difference of the two proportions is
taken once a common run and multiplied by its length. (Reordering rows for runs: after
Lemire, Kaser, "Reordering Columns for Smaller Indexes".)

Terms are counted in tasks before the shuffle. A language's distinct count rows
are dealt into blocks of bounded size, and its sources into tiles, so neither a hot
source nor a large vocabulary is held in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.terms import byte_table, counted, numbered_terms
from quarry.operators.joins import join_small
from quarry.session import ensure_checkpoint_dir

SCALE = 1_000_000_000
PRIOR = 5
_LETTERS = byte_table(digits=False)
_HELD = 250_000  # counted rows a task keeps before it passes them on


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, df``: occurrences and documents of terms, partly summed.

    A group's documents without terms give a row with a null term.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "source", "term", "n", "df"]
        held: list[pa.Table] = []
        size = 0

        def summed() -> pa.Table:
            whole = pa.concat_tables(held).group_by(names[:3]).aggregate([("n", "sum"), ("df", "sum")])
            return whole.rename_columns(names)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows, numbers, terms = numbered_terms(batch.column(2), _LETTERS)
            labels = pa.Table.from_arrays([batch.column(0), batch.column(1), pa.array(np.arange(batch.num_rows))],
                                          names=["lang", "source", "row"])
            groups = labels.group_by(["lang", "source"]).aggregate([("row", "list")])
            members = groups["row_list"].combine_chunks()
            group_of = np.empty(batch.num_rows, np.int64)
            group_of[members.flatten().to_numpy()] = np.repeat(np.arange(len(groups)), np.diff(members.offsets.to_numpy()))
            row, number, n = counted(rows, numbers, len(terms))
            key, place = np.unique(group_of[row] * max(1, len(terms)) + number, return_inverse=True)
            own, word = key // max(1, len(terms)), key % max(1, len(terms))
            total = np.zeros(len(key), np.int64)
            np.add.at(total, place, n)
            found = pa.Table.from_arrays(
                [groups["lang"].combine_chunks().take(pa.array(own)), groups["source"].combine_chunks().take(pa.array(own)),
                 terms.take(pa.array(word)).cast(pa.large_string()), pa.array(total),
                 pa.array(np.bincount(place, minlength=len(key)).astype(np.int64))], names=names)
            bare = pa.Table.from_arrays(
                [groups["lang"].combine_chunks(), groups["source"].combine_chunks(), pa.nulls(len(groups), pa.large_string()),
                 pa.array(np.zeros(len(groups), np.int64)), pa.array(np.zeros(len(groups), np.int64))], names=names)
            held += [found, bare]
            size += len(found) + len(bare)
            if size > _HELD:
                held = [summed()]
                size = len(held[0])
                if size > _HELD // 2:
                    yield from _strings(held[0]).to_batches(max_chunksize=50_000)
                    held, size = [], 0
        if held:
            yield from _strings(summed()).to_batches(max_chunksize=50_000)

    column = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(column("lang"), column("source"), column("text")).mapInArrow(
        run, "lang string, source string, term string, n long, df long")


def _strings(table: pa.Table) -> pa.Table:
    return table.set_column(2, "term", table["term"].cast(pa.string()))


def proportion(count: str, total: str, kept: str) -> str:
    """SQL for the exact p of a count, of the group's total and of the number of kept terms."""
    return (f"1 + ((cast({SCALE} as decimal(10,0)) * cast({count} + {PRIOR} as decimal(19,0))) "
            f"div cast({total} + {PRIOR} * {kept} as decimal(19,0)))")


def proportions(counts: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    """As :func:`proportion`, for ``bottom`` = total + 5 * kept below 9.2e15: long division, three digits a step."""
    rest = counts + PRIOR
    out = rest // bottom
    rest = rest % bottom
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // bottom
        rest = rest % bottom
    return out + 1


def run_starts(columns: np.ndarray) -> list[np.ndarray]:
    """Where each column's runs of equal values begin."""
    change = np.ones(columns.shape, bool)
    change[1:] = columns[1:] != columns[:-1]
    return [np.flatnonzero(change[:, c]) for c in range(columns.shape[1])]


def run_differences(counts: np.ndarray, length: np.ndarray, bottom: np.ndarray, left: np.ndarray,
                    right: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(a, b, sum of abs(p - q) over the rows) for ``a`` of ``left`` and ``b`` of ``right``, a < b.

    A row stands for ``length`` terms. Columns are encoded as runs; each pair's run
    boundaries are intersected.
    """
    before = np.r_[0, np.cumsum(length)]
    starts = run_starts(counts)
    values = [proportions(counts[s, c], bottom[c]) for c, s in enumerate(starts)]
    for a in left.tolist():
        for b in right.tolist():
            if a >= b:
                continue
            both = np.union1d(starts[a], starts[b])
            p = values[a][np.searchsorted(starts[a], both, side="right") - 1]
            q = values[b][np.searchsorted(starts[b], both, side="right") - 1]
            size = before[np.r_[both[1:], len(length)]] - before[both]
            yield a, b, int((np.abs(p - q) * size).sum())


def _pair_sums(kept: DataFrame, groups: DataFrame, block_rows: int, tile: int) -> DataFrame:
    """``lang, a, b, value``: partial sums of abs(p - q) for the sources numbered a < b of a language.

    ``kept`` has ``lang, term, at, n`` (at: the source's number), ``groups`` ``lang, at, bottom``.
    """
    rows = kept.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("cells"))
    rows = rows.groupBy("lang", "cells").agg(F.count("*").alias("length")).checkpoint()
    shape = rows.groupBy("lang").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    shape = groups.groupBy("lang").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles")).join(shape, "lang")
    tiles = F.expr("transform(sequence(0, tiles - 1), t -> t)")
    pairs = F.explode(F.flatten(F.transform(tiles, lambda i: F.transform(
        F.sequence(i, F.col("tiles") - 1), lambda j: F.struct(i.alias("i"), j.alias("j"))))))
    at = lambda x: F.floor(x / tile)
    own = lambda c: (at(c) == F.col("pair.i")) | (at(c) == F.col("pair.j"))
    columns = ["lang", "block", "i", "j", "role", "cells", "n"]
    # One row a language: broadcast only within the session's limit, else a join on the language.
    data = (join_small(rows, shape, ["lang"], null_safe=False).withColumn("block", F.pmod(F.xxhash64("cells"), F.col("blocks")))
            .withColumn("pair", pairs)
            .withColumn("cells", F.filter("cells", lambda x: own(x["at"])))
            .select("lang", "block", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), F.lit(1).alias("role"),
                    "cells", F.col("length").alias("n")))
    heads = (groups.join(shape, "lang").withColumn("pair", pairs).where(own(F.col("at")))
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks").cast("bigint") - 1)))
             .select("lang", "block", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), F.lit(0).alias("role"),
                     F.array(F.struct("at", F.col("bottom").alias("n"))).alias("cells"), F.lit(0).cast("bigint").alias("n")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang, _, i, j), (kind, cells, length) in _grouped(batches):
            at = cells.flatten().field(0).to_numpy().astype(np.int64)
            n = cells.flatten().field(1).to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(kind)), np.diff(cells.offsets.to_numpy()))
            head = kind[row] == 0
            sources, order = np.unique(at[head], return_index=True)
            bottom = n[head][order]
            first = int((kind == 0).sum())
            counts = np.zeros((len(kind) - first, len(sources)), np.int64)
            counts[row[~head] - first, np.searchsorted(sources, at[~head])] = n[~head]
            left, right = np.flatnonzero(sources // tile == i), np.flatnonzero(sources // tile == j)
            got = list(run_differences(counts, length[first:], bottom, left, right)) if len(counts) else []
            if got:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(got)), pa.array(sources[[g[0] for g in got]]), pa.array(sources[[g[1] for g in got]]),
                     pa.array([g[2] for g in got], pa.int64())], names=["lang", "a", "b", "value"])

    keys = ["lang", "block", "i", "j"]
    dealt = data.select(columns).unionByName(heads.select(columns)).repartition(*keys).sortWithinPartitions(*keys, "role", "cells")
    return dealt.select(columns).mapInArrow(run, "lang string, a long, b long, value long")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, tuple[np.ndarray, pa.Array, np.ndarray]]]:
    """Each (lang, block, i, j) of sorted rows with its roles, cells and lengths."""
    held: list[pa.RecordBatch] = []
    last = None

    def whole() -> tuple[np.ndarray, pa.Array, np.ndarray]:
        table = pa.Table.from_batches(held).combine_chunks()
        cells = table["cells"].combine_chunks()
        return table["role"].to_numpy(), cells, table["n"].to_numpy()

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True))
        a = 0
        for b in range(1, len(keys) + 1):
            if b < len(keys) and keys[b] == keys[a]:
                continue
            if held and keys[a] != last:
                yield last, whole()
                held = []
            last = keys[a]
            held.append(batch.slice(a, b - a))
            a = b
    if held:
        yield last, whole()


def source_divergence(docs: DataFrame, least_docs: int = 30, top: int = 50, block_rows: int = 4096,
                      tile: int = 128) -> DataFrame:
    """``lang, source, part, item, value, rank`` for the groups of ``docs(text, lang, source)``.

    Null text, language or source is the empty string. A language keeps the terms in at
    least ``least_docs`` of its rows (repeated rows count each). Part ``pair``: the other
    sources of the language by the summed difference of proportions; part ``term``: the ``top``
    kept terms a group has more of than its language. A language without kept terms has value 0
    for every pair and no terms; a group without terms takes part with counts of 0. An empty
    table gives no rows. Other columns are ignored.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    # One shuffle brings a term's rows together: its counts by source, its documents in the language and the choice
    # of kept terms all follow in the same tasks. A term has a row a source.
    counts = term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("df").alias("df"))
    term = Window.partitionBy("lang", "term")
    counts = counts.withColumn("lang_n", F.sum("n").over(term)).withColumn("lang_df", F.sum("df").over(term)).where(
        F.col("term").isNull() | (F.col("lang_df") >= least_docs)).drop("df", "lang_df").checkpoint()
    groups = counts.where("term is null").select("lang", "source")
    kept = counts.where("term is not null")
    vocabulary = kept.select("lang", "term", "lang_n").distinct()
    zero = F.lit(0).cast("bigint")
    size = vocabulary.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    total = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    known = groups.join(total, ["lang", "source"], "left").join(size, "lang", "left").select(
        "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("v", zero).alias("v"),
        F.coalesce("lang_total", zero).alias("lang_total"),
        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("bigint").alias("at")).checkpoint()
    # Sums of total + 5 * v below 9.2e15 occurrences a group are exact in 64-bit steps.
    cells = kept.join(known.select("lang", "source", "at", "total", "v", "lang_total"), ["lang", "source"])

    sums = _pair_sums(cells.select("lang", "term", "at", "n"), known.where("v > 0").select(
        "lang", "at", (F.col("total") + PRIOR * F.col("v")).alias("bottom")), block_rows, tile)
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    left = known.select("lang", "source", F.col("at").alias("a"))
    right = known.select("lang", F.col("source").alias("item"), F.col("at").alias("b"))
    pairs = left.join(right, "lang").where("a <> b").join(both, ["lang", "a", "b"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", zero).alias("value"))

    p = F.expr(proportion("n", "total", "v"))
    q = F.expr(proportion("lang_n", "lang_total", "v"))
    terms = cells.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                         (p - q).cast("bigint").alias("value")).where("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(terms).where(F.col("rank") <= top))
