import random

import brute

from featuremap.llm import _blocks, line_dedup


def rows():
    r = random.Random(5)
    line = lambda: r.choice(["Shared line number %d" % r.randint(0, 15), "  SHARED line number %d\t" % r.randint(0, 15),
                             "short", "", "exactly10!", "own %d" % r.randint(0, 10 ** 9), "ünïcödé", "éééééééééé"])
    out = [(i, "\n".join(line() for _ in range(r.randint(0, 12)))) for i in range(70)]
    return out + [(100, None), (101, ""), (102, "a line that repeats\n" * 50), (103, "A Line That Repeats"),
                  (None, "a line that repeats"), (None, "only without an id"), (3, "twice under one id"),
                  (3, "twice under one id"), (-7, "exactly10!\r\nexactly10!")]


def digest(df):
    from pyspark.sql import functions as F

    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.k) for r in df.withColumn(
        "k", F.sha2("text", 256)).collect()), key=str)


def test_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(_blocks, "BLOCK_BYTES", 600)            # several blocks and shards
    monkeypatch.setattr(line_dedup, "SHARD_LINES", 6)
    docs = spark.createDataFrame([(t, i, 1, "b") for i, t in rows()], "text string, doc_id long, n int, block string")
    out = line_dedup.dedup_lines(docs, report=True)
    assert out.columns == ["text", "doc_id", "n", "block", "n_lines", "n_dropped"]
    assert digest(out) == sorted(brute.line_dedup(rows()), key=str)


def test_empty_table_and_no_repeats(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.dedup_lines(docs).count() == 0
    docs = spark.createDataFrame([(1, "one of a kind"), (2, "another of a kind")], "doc_id long, text string")
    assert sorted(r.text for r in line_dedup.dedup_lines(docs).collect()) == ["another of a kind", "one of a kind"]


def test_index_has_every_distinct_line(spark, tmp_path):
    import numpy as np

    docs = spark.createDataFrame([(1, "a line of one\nshared by two documents"), (2, "Shared by two documents "),
                                  (3, "twice in here\ntwice in here\nshort")], "doc_id int, text string")
    path = str(tmp_path / "index")
    assert line_dedup.build_index(docs, path) == 1
    row = spark.read.parquet(path).first()
    counts, owners = (np.frombuffer(row[c], "<i8").tolist() for c in ("counts", "owners"))
    assert sorted(zip(counts, owners, strict=True)) == [(1, 1), (2, 1), (2, 3)]


def test_ids_keep_their_type(spark):
    import pytest

    rows = [(2, "a line of both"), (1, "a line of both"), (None, "a line of both")]
    for kind in ("tinyint", "int", "long"):
        docs = spark.createDataFrame(rows, f"doc_id {kind}, text string")
        out = line_dedup.dedup_lines(docs)
        assert out.schema == docs.schema
        assert sorted(map(tuple, out.collect()), key=str) == [(1, "a line of both"), (2, ""), (None, "")]
    with pytest.raises(TypeError, match="whole numbers"):
        line_dedup.dedup_lines(spark.createDataFrame([("x", "t")], "doc_id string, text string"))
