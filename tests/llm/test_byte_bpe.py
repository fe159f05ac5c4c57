import hashlib
import random

import public_tokenizers
import pytest

from featuremap.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def texts():
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdeéß漢🙂1'.,!") for _ in range(r.randint(1, 9)))
    gap = lambda: r.choice([" ", " ", " ", "  ", "\n", "  \n", "\t ", " ", "   "])
    long = "".join(word() + gap() for _ in range(900))
    return [None, "", " ", "a", "it's we'll <|endoftext|>", long, long, "x" * 700, " " * 500,
            "word " * 300 + " " * 90 + "tail" + "y" * 200 + " end " * 100, "\n".join("ab" for _ in range(200))]


@pytest.mark.parametrize(("chunk", "overlap"), [(32_768, 512), (64, 16), (100, 7)])
def test_same_ids_as_the_whole_text(spark, chunk, overlap):
    rows = [(i, t, "extra", i % 2) for i, t in enumerate(texts())] + [(None, "no id here " * 40, "extra", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string, n int")
    coded = byte_bpe.encode(docs, PATH, chunk=chunk, overlap=overlap)
    assert coded.columns == ["doc_id", "part", "n", "ids"]
    enc = byte_bpe.encoding(PATH)
    got = sorted(((r.doc_id, r.part, r.n, tuple(r.ids)) for r in coded.collect()), key=str)
    want = sorted(((i, p, n, tuple(enc.encode_ordinary(t or ""))) for i, t, p, n in rows), key=str)
    assert got == want
    back = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode(coded, PATH).collect()}
    assert back == {i: (t or "").encode() for i, t, _, _ in rows}


def test_long_texts_beside_columns_of_any_type(spark):
    long = "some words here and there " * 40
    rows = [(1, long, {"a": 1}, [{"k": 2}]), (1, long, {"a": 1}, [{"k": 2}]), (2, long + "x", None, None), (3, "s", {}, [])]
    docs = spark.createDataFrame(rows, "doc_id int, text string, m map<string,int>, `a.b` array<map<string,int>>")
    coded = byte_bpe.encode(docs, PATH, chunk=50, overlap=20, digest=True)
    assert coded.schema["doc_id"].dataType.simpleString() == "int"
    enc = byte_bpe.encoding(PATH)
    got = sorted(((r.doc_id, r.m, r["a.b"], list(r.ids)) for r in coded.collect()), key=str)
    assert got == sorted(((i, m, a, enc.encode_ordinary(t)) for i, t, m, a in rows), key=str)


def test_repeated_long_rows_and_empty_table(spark):
    long = "some words here and there " * 40
    docs = spark.createDataFrame([(1, long), (1, long), (2, long)], "doc_id long, text string")
    coded = byte_bpe.encode(docs, PATH, chunk=50, overlap=20)
    assert sorted(r.doc_id for r in coded.collect()) == [1, 1, 2]
    assert byte_bpe.encode(docs.limit(0), PATH).count() == 0
    want = hashlib.sha256(long.encode()).hexdigest()
    digest = byte_bpe.decode(coded, PATH, digest=True).collect()
    assert {r.decoded_sha256 for r in digest} == {want}
    both = docs.unionByName(spark.createDataFrame([(3, "short"), (4, None)], "doc_id long, text string"))
    got = {r.doc_id: r.decoded_sha256 for r in byte_bpe.encode(both, PATH, chunk=50, overlap=20, digest=True).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {1: want, 2: want, 3: sha("short"), 4: sha("")}
