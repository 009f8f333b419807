"""Connected components of an edge list.

Up to ``SMALL`` edges (counted) one task finds them with arrays of some tens of
MB; beyond, label propagation with pointer jumps does in the cluster.  Both
give the smallest node of each component, so which one ran makes no difference
to the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import cut


SMALL = 500_000


def _labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node number of each node's component, for edges between node numbers under n."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _in_one_task(edges: DataFrame) -> DataFrame:
    def over(batches):
        both = pa.Table.from_batches([x for x in batches if x.num_rows], schema=schema)
        if not both.num_rows:
            return
        nodes = sorted(set(both.column("a").to_pylist()) | set(both.column("b").to_pylist()))
        number = {x: i for i, x in enumerate(nodes)}
        a, b = (np.array([number[x] for x in both.column(c).to_pylist()]) for c in ("a", "b"))
        label = _labels(a, b, len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array([nodes[i] for i in label.tolist()], pa.binary())], names=["node", "label"])

    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    return edges.select("a", "b").coalesce(1).mapInArrow(over, "node binary, label binary")


def components(edges: DataFrame, small: int = SMALL) -> DataFrame:
    """(node, label) of every node of edges (a, b), both binary: label is the smallest node reachable.

    Each round takes the smallest label among a node and its neighbours and
    then the label of that label, so stars settle in one round and chains in a
    number of rounds near the logarithm of their length.  Rounds are written
    to the shared folder, so lineage does not grow; only one count a round
    reaches the driver.  Null-free edges are expected; no edges, no rows.
    """
    edges = cut(edges.select("a", "b"))
    if edges.count() <= small:
        return cut(_in_one_task(edges))
    both = cut(edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a")).distinct())
    label = cut(both.groupBy("node").agg(F.min("other").alias("o")).select("node", F.least("node", "o").alias("label")))
    while True:
        seen = both.join(label.select(F.col("node").alias("other"), F.col("label").alias("l")), "other").groupBy("node").agg(F.min("l").alias("l"))
        near = label.join(seen, "node").select("node", F.col("label").alias("was"), F.least("label", "l").alias("label"))
        jump = label.select(F.col("node").alias("label"), F.col("label").alias("far"))
        moved = cut(near.join(jump, "label").select("node", "was", F.least("label", "far").alias("label")))
        label = moved.select("node", "label")
        if moved.filter("was <> label").isEmpty():
            return label
