import random
import unicodedata

import brute

from featuremap.llm import quality_ledger as Q
from featuremap.llm import queries


def texts():
    r = random.Random(1)
    word = lambda: r.choice(["the", "a", "Ünit", "x" * 50, "&&", "of", "###", "NO!!", "漢字", "🙂"])
    out = [None, "", " \n\t", "one", "a b c d e a b c d e", "a b c d e f a b c d e", "\n".join(["same line here"] * 9),
           " lead  and\x0btrail \r\n", "x" * 100_000, "w " * 30_000, "a b c " * 12]
    return out + ["".join(word() + r.choice(" \n ") for _ in range(r.randint(1, 80))) for _ in range(60)]


def test_measures_and_policies(spark):
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(texts())] + [(None, "a b", "y", 1)] * 2,
                                 "doc_id long, text string, n_words string, w int")
    book = Q.ledger(docs)
    got = book.collect()
    assert len(got) == len(texts()) + 2
    for r in got:
        text = texts()[r.doc_id] if r.doc_id is not None else "a b"
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality(text), repr(text[:60])
    kept = {r.doc_id for r in Q.apply_policy(book, "base").filter("kept").collect()}
    want = {i for i, t in enumerate(texts()) if (m := brute.quality(t))[0] >= 10 and 100 * m[4] <= 20 * m[0]}
    assert kept == want
    rows = Q.keep(docs, "base").collect()
    assert {r.doc_id for r in rows} == want and rows[0].asDict().keys() == {"doc_id", "text", "n_words", "w"}
    assert all(r.n_words == "x" for r in rows)


def test_ablation_counts_by_bits(spark):
    book = spark.createDataFrame([(0,), (0,), (1,), (2,), (3,), (4,), (5,), (64,)], "fail_bits long")
    policies = {"a": ("few_words", "symbols"), "b": ("few_words",)}
    got = {(r.policy, r.rule): (r.n_failed, r.n_only, r.n_kept, r.n_kept_without)
           for r in Q.ablation(book, policies).collect()}
    assert got == {("a", "few_words"): (3, 2, 4, 6), ("a", "symbols"): (2, 1, 4, 5), ("b", "few_words"): (3, 3, 5, 8)}
    empty = Q.ledger(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.count() == 0 and Q.ablation(empty).count() == 0


def test_stored_ledger_and_ablation_of_all_documents(spark, tmp_dir, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    failed = {}
    for d in docs.collect():
        t = d.text or ""
        n, chars, symbols, dup, repeat = brute.quality(t)
        lines = sum(bool(x.strip(Q.SPACE)) for x in t.split("\n"))
        upper = sum(unicodedata.category(c) == "Lu" for c in t)
        failed[d.doc_id] = {name for name, bad in (
            ("few_words", n < 10), ("repeated_words", 100 * repeat > 20 * n), ("symbols", 100 * symbols > 20 * n),
            ("shouting", chars >= 20 and 100 * upper > 50 * chars), ("exclamations", 100 * t.count("!") > 50 * n),
            ("repeated_lines", 100 * dup > 50 * lines), ("long_words", chars > 40 * n)) if bad}
    want = {}
    for p, rules in Q.POLICIES.items():
        bad = [f & set(rules) for f in failed.values()]
        for r in rules:
            want[p, r] = (sum(r in b for b in bad), sum(b == {r} for b in bad), sum(not b for b in bad),
                          sum(b <= {r} for b in bad))
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"{tmp_dir}/{name}")
    out = queries.QUERIES["op9_quality_ledger"](spark, "/root/testdata/sf0.01")
    assert {r.doc_id: r.kept for r in out.collect()} == {i: not f & set(Q.POLICIES["v1"]) for i, f in failed.items()}
    assert spark.read.parquet(f"{tmp_dir}/quality/ledger").count() == len(failed)
    got = {(r.policy, r.rule): (r.n_failed, r.n_only, r.n_kept, r.n_kept_without)
           for r in spark.read.parquet(f"{tmp_dir}/quality/ablation").collect()}
    assert got == want


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = Q.apply_policy(Q.ledger(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
