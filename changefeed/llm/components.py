"""Connected components of a distributed edge list."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.session import settle

EDGES_EACH = 100_000  # edges of a task, about
_TOGETHER = 1 << 18  # edges contracted together


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of some edges but the smallest of its component, and that one."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            own = label != np.arange(len(nodes))
            return nodes[own], nodes[label[own]]
        label = new


def _contracted(batches):
    """Edges (u, v) of a task replaced by as few as connect the same nodes, u the larger end."""

    def forest(held):
        u, v = _forest(*(np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= _TOGETHER:
            yield forest(held)
            held, size = [], 0
    if size:
        yield forest(held)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge.

    ``edges`` has BIGINT columns u and v. First each task replaces its edges by a
    forest over the same nodes; fewer than ``EDGES_EACH`` are one task's, whose forest is the result. Each round links all larger neighbours
    of a node to its smallest neighbour, then all smaller ones, until every node
    hangs on its smallest directly. A round is grouping by minimum and joins on
    narrow rows: no neighbour list is ever gathered, however large a hub is.
    """

    def starred(pairs: DataFrame, larger: bool) -> DataFrame:
        both = pairs.select("u", "v")
        if larger:
            both = both.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        linked = both.join(least, "u")
        if larger:
            return linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        own = least.select("u", F.col("m").alias("v"))
        return (
            linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(own)
            .filter("u > v")
            .distinct()
        )

    def gathered(df: DataFrame, number: int) -> DataFrame:
        """Few edges lie in few tasks."""
        return df.coalesce(number // EDGES_EACH + 1)

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    # u is the larger end throughout
    current = settle(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    number = current.count()
    current = settle(gathered(current, number).mapInArrow(_contracted, "u bigint, v bigint"))
    whole = number < EDGES_EACH <= _TOGETHER  # in one task, and there in one forest
    seen = (0,) if whole else state(current)
    while seen[0]:
        current = settle(gathered(starred(starred(current, True), False), seen[0]))
        now = state(current)
        if now == seen:
            break
        seen = now
    own = current.select(F.col("v").alias("u"), "v").distinct()
    return current.unionByName(own).select(F.col("u").alias("node"), F.col("v").alias("component"))
