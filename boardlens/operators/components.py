"""Connected components of graphs that come in groups (a board, a frame), whatever the size of a group.

Tasks first contract the edges they hold, batch by batch, then star joins over written edge tables
join what the batches have left. Every node gets the smallest node id of its component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlens.operators.lineage import cut

BATCH_EDGES = 1 << 18  # edges a task contracts at once


def smallest_reachable(n: int, src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """Label of each of n nodes: the smallest node number it is connected to."""
    label = np.arange(n)
    while len(src):
        low = np.minimum(label[src], label[dst])
        np.minimum.at(label, label[src], low)
        np.minimum.at(label, label[dst], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        open_edges = label[src] != label[dst]
        src, dst = src[open_edges], dst[open_edges]
    return label


def _batch_stars(edges: pd.DataFrame, on: list[str]) -> pd.DataFrame:
    """The components of some edges as links from every node to the smallest one."""
    key = edges[on].to_numpy()
    ends = np.vstack([np.column_stack([key, edges["_src"]]), np.column_stack([key, edges["_dst"]])])
    order = np.lexsort(ends.T[::-1])
    ordered = ends[order]
    fresh = np.ones(len(ordered), dtype=bool)
    fresh[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    code = np.empty(len(ordered), dtype=np.int64)
    code[order] = np.cumsum(fresh) - 1
    nodes = ordered[fresh]
    label = smallest_reachable(len(nodes), code[: len(edges)], code[len(edges) :])
    tied = np.flatnonzero(label != np.arange(len(nodes)))
    out = pd.DataFrame(nodes[tied], columns=[*on, "_src"])
    return out.assign(_dst=nodes[label[tied], -1])


def _contracted(edges: DataFrame, on: list[str], batch_edges: int) -> DataFrame:
    """Fewer edges with the same components."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        n = 0
        for pdf in batches:
            held.append(pdf)
            n += len(pdf)
            if n >= batch_edges:
                yield _batch_stars(pd.concat(held, ignore_index=True), on)
                held, n = [], 0
        if n:
            yield _batch_stars(pd.concat(held, ignore_index=True), on)

    ids = [T.StructField(c, T.LongType()) for c in ("_src", "_dst")]
    return edges.mapInPandas(run, T.StructType([*(edges.schema[c] for c in on), *ids]))


def _star_contract(edges: DataFrame, on: list[str], batch_edges: int) -> DataFrame:
    """Alternate large-star and small-star steps until the edges are stars around the minimum.

    Every step is a partial aggregation of minima and one join; a hub node is a skewed key of that
    join whose other side is one row, which adaptive execution splits.
    """
    current = cut(_contracted(edges.filter("_src <> _dst").select(*on, "_src", "_dst"), on, batch_edges).distinct())
    seen: tuple | None = None
    while True:
        both = current.unionByName(current.select(*on, F.col("_dst").alias("_src"), F.col("_src").alias("_dst")))
        low = both.groupBy(*on, "_src").agg(F.least(F.min("_dst"), F.first("_src")).alias("_min"))
        large = both.filter("_dst > _src").join(low, [*on, "_src"]).select(*on, F.col("_dst").alias("_src"), F.col("_min").alias("_dst"))
        large = large.filter("_src <> _dst").distinct()
        down = large.select(*on, F.greatest("_src", "_dst").alias("_src"), F.least("_src", "_dst").alias("_dst"))
        root = down.groupBy(*on, "_src").agg(F.min("_dst").alias("_min"))
        small = down.join(root, [*on, "_src"]).select(*on, F.col("_dst").alias("_src"), F.col("_min").alias("_dst"))
        small = small.unionByName(root.select(*on, "_src", F.col("_min").alias("_dst")))
        current = cut(small.filter("_src <> _dst").distinct())
        digest = current.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64(*on, "_src", "_dst").cast("decimal(38,0)")).alias("h"),
        ).first()
        if tuple(digest) == seen:
            return current.select(*on, F.col("_src").alias("_id"), F.col("_dst").alias("comp"))
        seen = tuple(digest)


def connected_components(
    nodes: DataFrame, edges: DataFrame, on: list[str], id_col: str, src: str, dst: str, batch_edges: int = BATCH_EDGES
) -> DataFrame:
    """``nodes`` with a column ``comp``. Integer ids are unique within a group, group columns are integers.

    ``edges`` have the group columns plus ``src`` and ``dst``, in either direction and with repeats. Further node columns are kept.
    """
    ids = edges.select(*on, F.col(src).cast("bigint").alias("_src"), F.col(dst).cast("bigint").alias("_dst"))
    stars = _star_contract(ids, on, batch_edges).withColumnRenamed("comp", "_comp")
    rows = nodes.withColumn("_id", F.col(id_col).cast("bigint"))
    return rows.join(stars, [*on, "_id"], "left").select(*nodes.columns, F.coalesce("_comp", "_id").alias("comp"))
