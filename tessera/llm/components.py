"""Consolidating pairwise matches into groups (problem 2).

Union-find runs inside edge partitions, each partition keeps only its spanning forest, and forests are merged
through partitions of bounded size until the components are global.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

#: Edges that one task may hold when the last forests are merged (two 8-byte ids each, so about 32 MB).
LAST_MERGE_EDGES = 2_000_000


def union_find(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and their roots (smallest id of the component) of an edge list.

    Union hooks the larger root under the smaller one for all edges at once; find is pointer jumping until every
    path has length one. Only nodes that are no root of their own are returned.
    """
    if not len(left):
        return left, right
    ids, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    u, v = at[: len(left)], at[len(left) :]
    parent = np.arange(len(ids))
    while True:
        a, b = parent[u], parent[v]
        open_ = a != b
        if not open_.any():
            break
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            jumped = parent[parent]
            if np.array_equal(jumped, parent):
                break
            parent = jumped
    moved = parent != np.arange(len(ids))
    return ids[moved], ids[parent[moved]]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning forest of a partition. Edges are folded in batch by batch, so memory holds the forest, not the edges."""
    left = right = np.zeros(0, np.int64)
    for batch in batches:
        left = np.concatenate([left, batch.column(0).to_numpy()])
        right = np.concatenate([right, batch.column(1).to_numpy()])
        if len(left) > 200_000:
            left, right = union_find(left, right)
    left, right = union_find(left, right)
    for at in range(0, len(left), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(left[at : at + 100_000]), pa.array(right[at : at + 100_000])], ["u", "v"])


def connected_components(edges: DataFrame, left: str, right: str, last_merge_edges: int = LAST_MERGE_EDGES) -> DataFrame:
    """``(component, node)`` for every node of ``edges``; ``component`` is the smallest node id of its component.

    * Rows with a null end are left out; an edge from a node to itself makes that node a component of its own;
      repeated edges and both directions change nothing; an empty input gives an empty result.
    * Other columns are ignored, whatever their names.
    * A node in very many edges costs each partition one forest edge, so no group is ever collected.
    * While more than ``last_merge_edges`` forest edges remain, leaves of the forests are retired with a pointer
      to their parent and the rest is repartitioned by one end, hubs over several partitions, and contracted again; the
      pointers are followed back at the end.
    """
    spark = edges.sparkSession
    e = edges.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v")).where("u is not null and v is not null")
    loops = e.where("u = v").select(F.col("u").alias("node")).distinct()
    forest = materialize(e.where("u <> v").mapInArrow(_forest, "u long, v long"), "forest")
    retired: list[DataFrame] = []
    turn = 0
    while (n := forest.count()) > last_merge_edges:
        turn += 1
        most = max(1, last_merge_edges // 2)
        parts = max(2, -(-n // most))
        # A forest edge (u, v) has u > v. A node that is nobody's parent leaves with its smallest parent; its other parents are linked.
        parents = forest.select(F.col("v").alias("u")).distinct().withColumn("inner_node", F.lit(True))
        by_node = forest.groupBy("u").agg(F.min("v").alias("least"), F.collect_set("v").alias("all"))
        marked = materialize(by_node.join(parents, "u", "left"), "marked")
        leaves = marked.where("inner_node is null")
        retired.append(leaves.select("u", F.col("least").alias("v")))
        among = leaves.select(F.explode("all").alias("u"), F.col("least").alias("v")).where("u <> v")
        kept = marked.where("inner_node").select("u", F.explode("all").alias("v"))
        key = F.least("u", "v") if turn % 2 else F.greatest("u", "v")
        rest = materialize(among.unionByName(kept).distinct().withColumn("meet", key), "rest")
        # a node with more edges than a task may hold is met in several; there are fewer such nodes than partitions
        hubs = rest.groupBy("meet").agg(F.count("*").alias("n")).where(F.col("n") > most)
        salt = F.pmod(F.xxhash64("u", "v"), F.coalesce(F.ceil(F.col("n") / most), F.lit(1)))
        spread = rest.join(F.broadcast(hubs), "meet", "left").select("u", "v", "meet", salt.alias("salt"))
        forest = materialize(spread.repartition(parts, "meet", "salt").select("u", "v").mapInArrow(_forest, "u long, v long"), "forest")
    found = materialize(forest.coalesce(1).mapInArrow(_forest, "u long, v long"), "merged").select(F.col("u").alias("node"), F.col("v").alias("component"))
    for pointers in reversed(retired):
        above = found.select(F.col("node").alias("v"), "component")
        below = pointers.join(above, "v", "left").select(F.col("u").alias("node"), F.coalesce("component", "v").alias("component"))
        found = materialize(found.unionByName(below), "labels")
    roots = found.select(F.col("component").alias("node")).distinct().withColumn("component", F.col("node"))
    both = found.select("node", "component").unionByName(roots)
    alone = loops.join(both, "node", "left_anti").withColumn("component", F.col("node"))
    return both.unionByName(alone.select("node", "component")).select("component", "node")
