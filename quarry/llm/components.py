"""Connected components of an edge table by contraction in tasks and pointer jumping.

Edges are stars ``(node, root)`` with the root below the node. A round brings
the edges of a node together, and each task replaces the components of the edges it holds
by stars around their least nodes (union by minimum in numpy, a bounded number of
edges at a time). A root that is itself a node then hands its nodes on to its own root.
That needs only the roots that have a root: they are found by distinct roots, so
the star of a node with very many neighbours is never shuffled by its centre,
and are broadcast only within the session's measured limit. Rounds end when every
node has one root and no root has one; each is checkpointed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.joins import join_small
from quarry.session import ensure_checkpoint_dir

HELD = 1 << 19


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each of ``n`` nodes' component under the edges ``a``-``b``."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
        a, b = label[a], label[b]  # contract: what is joined needs no second look
        open_ = a != b
        a, b = a[open_], b[open_]
    while True:
        jumped = label[label]
        if (jumped == label).all():
            return label
        label = jumped


def _stars(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """``a, b, moved``: the components of some edges as stars; ``moved`` where a node's root is not the one it came with."""
    nodes, place = np.unique(np.r_[a, b], return_inverse=True)
    label = least_labels(len(nodes), place[:len(a)], place[len(a):])
    own = np.flatnonzero(label != np.arange(len(nodes)))
    had = np.full(len(nodes), -1, np.int64)
    had[place[:len(a)]] = place[len(a):]
    return pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[label[own]]), pa.array(had[own] != label[own])],
                                      names=["a", "b", "moved"])


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """:func:`_stars` of at most about ``HELD`` edges at a time; the edges of one ``a`` in a row stay together."""
    a, b, size = [], [], 0
    for batch in batches:
        a.append(np.asarray(batch.column(0)))
        b.append(np.asarray(batch.column(1)))
        size += batch.num_rows
        if size < HELD:
            continue
        every_a, every_b = np.concatenate(a), np.concatenate(b)
        other = np.flatnonzero(every_a != every_a[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield _stars(every_a[:cut], every_b[:cut])
            a, b = [every_a[cut:]], [every_b[cut:]]
        else:  # all of one node: it keeps its least root, which the others get too
            low = every_b.min()
            rest = np.unique(every_b[every_b > low])
            if len(rest):
                yield _stars(rest, np.full(len(rest), low))
            a, b = [every_a[:1]], [np.array([low])]
        size = len(a[0])
    if size:
        yield _stars(np.concatenate(a), np.concatenate(b))


def components(edges: DataFrame) -> DataFrame:
    """``edges(a long, b long)`` to ``(node, root)``; root is the least node id.

    Nodes without an edge to another node do not appear. Null ends are dropped;
    repeated edges count once. An empty table gives no rows.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    schema = "a long, b long, moved boolean"
    now = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).mapInArrow(_contracted, schema)
    while True:
        now = now.select("a", "b").repartition("a").sortWithinPartitions("a").mapInArrow(_contracted, schema).checkpoint()
        ends = F.explode(F.array(F.struct(F.col("a").alias("b"), F.col("b").alias("up"), "moved"),
                                 F.struct("b", F.lit(None).cast("bigint").alias("up"), F.lit(None).cast("boolean").alias("moved"))))
        changes = now.select(ends.alias("x")).select("x.*").groupBy("b").agg(
            F.min("up").alias("up"), F.bool_or("moved").alias("moved"), F.count(F.when(F.col("up").isNull(), 1)).alias("as_root"))
        changes = changes.where("up is not null and (moved or as_root > 0)").select("b", F.when(F.col("as_root") > 0, F.col("up")).alias("up")).checkpoint()
        changed, jumping = changes.agg(F.count("*"), F.count("up")).first()
        if not changed:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        if jumping:
            jumps = changes.where("up is not null")
            now = join_small(now, jumps, ["b"], "left", null_safe=False, known_rows=jumping).select("a", F.coalesce("up", "b").alias("b"))
