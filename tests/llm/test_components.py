import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from featuremap.llm import _components
from featuremap.llm._components import extended, measured


def roots(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in root}


def test_extended_step_by_step_like_union_find(spark):
    r, labels, seen = random.Random(5), None, []
    path = [(i, i + 1) for i in range(60)]
    hub = [(100, i) for i in range(101, 160)]
    some = [(r.randint(200, 400), r.randint(200, 400)) for _ in range(80)]
    links = [(30, 100), (55, 210), (210, 399), (500, 501), (3, 3), (7, 8)]
    for edges in (path[::2] + some[:40], path[1::2] + hub, [], some[40:] + links):
        df = spark.createDataFrame([*edges, (None, 1), (2, None)], "x long, y long")
        labels = extended(labels, df, "x", "y")
        seen += [e for e in edges if e[0] != e[1]]
        assert {row.node: row.root for row in labels.collect()} == roots(seen)
        assert labels.count() == len(roots(seen))


def test_no_plan_holds_a_lineage_twice(spark, monkeypatch):
    """The driver's memory follows the plans: a step that joined an unwritten table with
    its own aggregates held dozens of exchanges, and every one a thread and its code."""
    plans, real = [], _components.stored

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        return real(df, name)

    monkeypatch.setattr(_components, "stored", seen)
    path = [(i, i + 1) for i in range(300)]
    random.Random(2).shuffle(path)
    df = spark.createDataFrame(path, "a long, b long").repartition(7)
    labels = extended(None, df.filter("a % 10 > 0"))
    labels = extended(labels, df.filter("a % 10 = 0"))
    assert {(r.node, r.root) for r in labels.collect()} == {(i, 0) for i in range(301)}
    assert max(plans) <= 6


def test_chunks_become_stars(monkeypatch):
    monkeypatch.setattr(_components, "CHUNK", 40)
    r = random.Random(3)
    edges = [(r.randint(0, 150), r.randint(0, 150)) for _ in range(200)]
    edges = [(max(e), min(e)) for e in edges if e[0] != e[1]]
    batches = [pa.RecordBatch.from_pylist([{"u": u, "v": v} for u, v in edges[k:k + 25]])
               for k in range(0, len(edges), 25)]
    empty = batches[0].slice(0, 0)
    stars = [x.to_pylist() for x in _components._chunks(iter([empty, *batches, empty]))]
    assert 1 < len(stars) < len(batches)
    for part in stars:
        assert len({e["u"] for e in part}) == len(part)
        assert not {e["u"] for e in part} & {e["v"] for e in part}
    assert roots([(e["u"], e["v"]) for part in stars for e in part]) == roots(edges)
    assert list(_components._chunks(iter([empty]))) == []


@pytest.mark.parametrize("rows", [0, 10])
def test_measured_while_written(spark, rows):
    df = spark.range(rows).filter("id % 2 = 0")
    out, got = measured(df, "some", n=F.count("*"), sum=F.sum("id"))
    assert out.count() == got["n"] == rows // 2
    assert got["sum"] == (20 if rows else None)
