"""Connected components of a graph in a table, by contraction, with every step written to the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.shared import stored, tidy

#: Edges that one task holds at once (16 bytes each, about ten times that while it works); larger graphs are contracted on the cluster first.
FEW = 1 << 19


def components(edges: DataFrame, folder: str, name: str = "cc", jumps: int = 2, few: int | None = None) -> DataFrame:
    """(node, label) for each node of ``edges`` (a, b): equal labels mean connected.

    Each round hooks a node to its least neighbour, follows that pointer a few
    times, and replaces the ends of all edges; edges inside a label go. With
    nodes in random order, as those of digests, rounds grow with the logarithm
    of the longest path; a path in order loses ``2 ** jumps`` edges a round.
    Once ``few`` edges are left (``FEW`` by default), one task finishes them:
    what a round costs on a small graph is its shuffles, not its edges. No
    table is collected.
    """
    few = FEW if few is None else few
    left = stored(edges.select("a", "b").filter("a <> b"), folder, f"{name}-0")
    labels = None
    k = 0
    while (n := left.count()) > few:
        k += 1
        if labels is None:
            labels = stored(left.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node")), folder, f"{name}-labels-0")
        both = left.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        up = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("up")), folder, f"{name}-up-{k}-0")
        for j in range(1, jumps + 1):
            further = up.select(F.col("a").alias("up"), F.col("up").alias("further"))
            up = stored(up.join(further.hint("merge"), "up", "left").select("a", F.coalesce("further", "up").alias("up")), folder, f"{name}-up-{k}-{j}")
        labels = stored(_renamed(labels, up.toDF("label", "to")), folder, f"{name}-labels-{k}")
        to = lambda c: up.select(F.col("a").alias(c), F.col("up").alias(f"{c}_up"))  # noqa: B023, E731
        moved = left.join(to("a").hint("merge"), "a").join(to("b").hint("merge"), "b").select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b"))
        left = stored(moved.filter("a <> b").distinct(), folder, f"{name}-{k}")
    if labels is not None and not n:
        return labels
    last = stored(left.coalesce(1).mapInArrow(tidy(_finish), "node long, label long"), folder, f"{name}-last")
    return last if labels is None else stored(_renamed(labels, last.toDF("label", "to")), folder, f"{name}-labels")


def _renamed(labels: DataFrame, to: DataFrame) -> DataFrame:
    """``labels`` (node, label) with the labels that ``to`` (label, to) has replaced."""
    return labels.join(to.hint("merge"), "label", "left").select("node", F.coalesce("to", "label").alias("label"))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The (node, label) of all edges of a task."""
    held = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    if held:
        node, label = least_nodes(*(np.concatenate(x) for x in zip(*held, strict=True)))
        for i in range(0, len(node), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 16)], pa.int64()) for x in (node, label)], names=["node", "label"])


def least_nodes(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the least node of the component of each) of the edges a[i] - b[i]."""
    node, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    up = np.arange(len(node))
    x, y = ends[: len(a)], ends[len(a) :]
    while len(x):
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))  # the ends are roots, so pointers only go from roots to lesser ones
        while (up[up] != up).any():
            up = up[up]
        x, y = up[x], up[y]
        x, y = x[x != y], y[x != y]
    return node, node[up]
