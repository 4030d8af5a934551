"""Connected components of an edge table by contraction in tasks and pointer jumps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import bitmaps
from tidewell.llm.scratch import Scratch, shuffled

#: Edges that a task holds before it contracts them to a forest of the nodes it has seen.
HELD = 1_000_000
#: Children from which a parent's edges are dealt over several tasks, and over how many.
HOT, SALTS = 1024, 32


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the edges but the least of its component, and that least node."""
    names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(names))
    while (root[a] != root[b]).any():
        np.minimum.at(root, np.maximum(root[a], root[b]), np.minimum(root[a], root[b]))
        while (root[root] != root).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(names)))
    return names[moved], names[root[moved]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A forest of the task's edges: a node is the child of one edge at most, so no node has more edges than there are tasks."""
    held, n = [], 0
    for batch in batches:
        held.append((batch["u"].to_numpy(), batch["v"].to_numpy()))
        n += batch.num_rows
        if n >= HELD:
            held, n = [_forest(*map(np.concatenate, zip(*held, strict=True)))], 0
    if held:
        u, v = _forest(*map(np.concatenate, zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def _jump(edges: DataFrame) -> DataFrame:
    """Link every node to the least parent of its parent. The edges of a parent of over HOT nodes are dealt over SALTS tasks, each with that parent's row."""
    parents = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "v")
    hot = bitmaps.build(edges.groupBy("v").count().where(F.col("count") > HOT), F.col("v"))
    if not hot.any():
        return edges.join(shuffled(parents), "v", "left").select("u", F.coalesce("m", "v").alias("v"))
    mark = bitmaps.marker(hot, "v")
    edges = edges.mapInArrow(mark, "u long, v long, hot boolean").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("u"), F.lit(SALTS))).otherwise(0).cast("int"))
    every = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    parents = parents.mapInArrow(mark, "v long, m long, hot boolean").select("v", "m", F.explode(every).alias("salt"))
    return edges.join(shuffled(parents), ["v", "salt"], "left").select("u", F.coalesce("m", "v").alias("v"))


def _is_forest(edges: DataFrame) -> bool:
    """Whether every node hangs on one least node; then another round would leave the edges as they are."""
    end = lambda x, up, down: F.struct(F.col(x).alias("node"), F.lit(up).alias("up"), F.lit(down).alias("down"))
    ends = edges.select(F.explode(F.array(end("u", 1, 0), end("v", 0, 1))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").count() == 0


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, comp) for every node of edges (a, b): comp is the least node that it reaches.

    An empty edge table gives an empty result. First each task contracts the edges it has; then, in each round, a
    node's edges meet in one task, which contracts them, and nodes jump to their parent's parent. Each round is
    written to the shared folder; rounds end with a star around each least node.
    """
    at = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    at, step = scratch.save(at.mapInArrow(_contract, "u long, v long"), f"{name}-0"), 0
    while True:
        step += 1
        met = scratch.save(at.repartition("u").mapInArrow(_contract, "u long, v long"), f"{name}-{step}-met")
        scratch.drop(f"{name}-{step - 1}")
        at = scratch.save(_jump(met), f"{name}-{step}")
        scratch.drop(f"{name}-{step}-met")
        if _is_forest(at):
            break
    return at.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(at.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
