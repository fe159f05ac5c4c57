import brute
import public_tokenizers
import pytest

import corpus_pipeline
from featuremap.llm import quality_ledger
from featuremap.llm.byte_bpe import encoding

SF = "/root/testdata/sf0.001"


def lines_kept(docs):
    key = lambda x: x.strip(brute.SPACE).translate(brute.LOW)
    holders = {}
    for i, text in docs:
        for x in text.split("\n"):
            holders.setdefault(key(x), set()).add(i)
    return [(i, "\n".join(x for x in text.split("\n") if len(key(x)) < 10 or min(holders[key(x)]) == i))
            for i, text in docs]


def verdict(text):
    n, chars, symbols, _, repeat = brute.quality(text)
    upper = sum(c.isupper() for c in text)
    return (n >= 10 and 100 * repeat <= 20 * n and 100 * symbols <= 20 * n and 100 * text.count("!") <= 50 * n
            and not (chars >= 20 and 100 * upper > 50 * chars))


@pytest.mark.parametrize("extra", [[], [(10_000, None), (10_001, ""), (10_002, "word " * 5000)]])
def test_stages_like_brute_force(spark, tmp_dir, extra):
    docs = spark.read.parquet(SF + "/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    if extra:
        rows = rows[:40] + extra
        more = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in extra], docs.schema)
        docs = docs.filter(docs.doc_id.isin([i for i, _ in rows])).unionByName(more)
    items = [(r.item_id, r.text) for r in spark.read.parquet(SF + "/benchmark.parquet").collect()]
    want = [(i, t) for i, t in rows if t and verdict(t)]
    names = [n for n, _ in corpus_pipeline.STAGES]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF)
        if name == "line_dedup":
            want = lines_kept(want)
        elif name == "near_duplicates":
            first = {c for _, _, c in brute.components(want)}
            want = [(i, t) for i, t in want if i in first]
        elif name == "decontamination":
            bad = {x[0] for x in brute.contamination(want, items) if x[-1]}
            want = [(i, t) for i, t in want if i not in bad]
        if k < len(names) - 1:
            docs.write.parquet(f"{tmp_dir}/{k}")
            docs = spark.read.parquet(f"{tmp_dir}/{k}")
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(want), name
    enc = encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    got = docs.collect()
    assert {r.doc_id: list(r.ids) for r in got} == {i: enc.encode_ordinary(t) for i, t in want}
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got)


def test_quality_policy_of_the_pipeline():
    assert quality_ledger.POLICIES["v1"][:2] == quality_ledger.BASE
