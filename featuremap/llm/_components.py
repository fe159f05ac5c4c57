"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from featuremap.llm._words import ready
from featuremap.session import scratch_path

#: edges that a task turns into stars at once
CHUNK = 1 << 18


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, name: str, **of: Column) -> tuple[DataFrame, dict]:
    """:func:`stored`, and aggregates of the rows, taken while they are written."""
    seen = Observation()
    out = stored(df.observe(seen, *(x.alias(k) for k, x in of.items())), name)
    got = seen.get
    if got.keys() != of.keys():
        got = out.agg(*(x.alias(k) for k, x in of.items())).first().asDict()
    return out, got


def _roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node that each reaches by the edges u - v)."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    root, u, v = np.arange(len(nodes)), ends[:len(u)], ends[len(u):]
    while True:
        a, b = root[u], root[v]
        if np.array_equal(a, b):
            return nodes, nodes[root]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root = up


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) as stars: what a task reads of them, ``CHUNK`` by ``CHUNK``."""
    def stars(some: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, v = (np.concatenate([x.column(k).to_numpy(zero_copy_only=False) for x in some]) for k in "uv")
        node, root = _roots(u, v)
        kept, kind = node != root, some[0].schema.field("u").type
        return pa.RecordBatch.from_arrays([pa.array(x[kept], kind) for x in (node, root)], names=["u", "v"])

    some, n = [], 0
    for batch in batches:
        if batch.num_rows:
            some.append(batch)
            n += batch.num_rows
        if n >= CHUNK:
            yield stars(some)
            some, n = [], 0
    if some:
        yield stars(some)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of its
    component.  Tasks first make stars of the edges they read.  While these are not
    all one star a component, a step of two aggregations by node follows, each written
    to the shared folder, so that no plan holds a table's lineage twice; the number of
    steps grows with the logarithm of the longest path.  Null ends and loops are
    ignored."""
    ready(edges.sparkSession)
    ends = (edges.filter(F.col(a) != F.col(b))
            .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    kind = ends.schema["u"].dataType.simpleString()
    now = stored(ends.mapInArrow(_chunks, f"u {kind}, v {kind}"), "components")
    while not _all_stars(now):
        # large star: each larger neighbour points to the smallest of the neighbourhood
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = stored(both.join(low, "u").filter("v > u")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-stars")
        # small star: a node and its smaller neighbours point to the smallest of them
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
        now = stored(small.select("x.u", "x.v").filter("u != v").distinct(), "components")
    star = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return star.union(star.select("root", "root").distinct())


def _all_stars(edges: DataFrame) -> bool:
    """Whether each node is either the larger end of one edge or no larger end."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("x"))
    many = ends.groupBy("x.node").agg(F.sum("x.up").alias("up"), F.count("*").alias("n"))
    return not many.filter("up > 0 and n > 1").head(1)


def extended(labels: DataFrame | None, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) as :func:`components` gives them for the edges of ``labels`` and
    ``edges`` together: only the roots that ``edges`` link are gone through again."""
    if labels is None:
        return stored(components(edges, a, b), "labels")
    of = lambda end: labels.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    roots = (edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
             .join(of("a"), "a", "left").join(of("b"), "b", "left")
             .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
    moved = components(roots)
    old = (labels.join(moved.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
           .select("node", F.coalesce("to", "root").alias("root")))
    return stored(old.union(moved.join(labels.select("node"), "node", "left_anti")), "labels")
