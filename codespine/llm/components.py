"""Connected components of a link table by rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, written

EDGES_AT_ONCE = 500_000


def forest(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """The least index that each of ``n`` nodes reaches over the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def contracted(pairs: DataFrame, tasks: int, *, every: bool = False) -> DataFrame:
    """Links with the same components, at most one for each node and task: every task replaces the links it holds, about
    ``EDGES_AT_ONCE``, by stars. Many links between the same few nodes become few. ``every``: centres are linked to themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches]
        if held:
            a, b = (np.concatenate(x) for x in zip(*held, strict=True))
            nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
            root = forest(place[: len(a)], place[len(a) :], len(nodes))
            linked = np.flatnonzero(every | (root != np.arange(len(nodes))))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(nodes[root[linked]])], names=["a", "b"])

    return pairs.repartition(tasks).mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node reachable, for every node of ``edges`` (``a``, ``b``).

    Each round every node takes the least label among its own, its neighbours' and its label's label, so that long chains
    shorten by doubling. Rounds are written to the shared folder. A node with very many links is a skewed join key (which
    adaptive execution splits) and a minimum (which is combined before the shuffle). No edges give no rows. Nodes are 64-bit integers.
    Up to ``EDGES_AT_ONCE`` links are one task's, whose stars are the components already, so there are no rounds.
    """
    ready(edges.sparkSession)
    links = written(edges.select("a", "b").where("a <> b"))
    tasks = max(1, -(-links.count() // EDGES_AT_ONCE))
    if tasks == 1:
        return written(contracted(links, 1, every=True)).select(F.col("a").alias("node"), F.col("b").alias("root"))
    pairs = contracted(links, tasks)
    both = written(pairs.union(pairs.select("b", "a")).distinct())
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")))
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("root").alias("near"))
        near = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        hop = labels.select(F.col("node").alias("root"), F.col("root").alias("hop"))
        new = F.least("root", "near", "hop")
        step = written(labels.join(near, "node", "left").join(hop, "root", "left").select("node", new.alias("root"), (new < F.col("root")).alias("moved")))
        labels = step.select("node", "root")
        if step.where("moved").isEmpty():
            return labels
