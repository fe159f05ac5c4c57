import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from featuremap.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(rows, end=2):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    return {(i, t): [*tok.encode(t or "", add_special_tokens=False).ids, end] for i, t in rows}


def test_units_give_the_ids_of_the_text():
    texts = ["", " ", "a", " a", "a ", "a  b", "  a", "x\n y\n\n z", "it's we'll ' s", "don't　 do \x1c !\x1c x",
             "tab\t here \t\t there", "漢字 かな 🙂 é ßß", "1 23 456.7 -8", "<|endoftext|> in text", "\n", "a\n", "!\x85 b", "one.\nTwo, three.\nfour.\n\nfive\n six\x85\nseven", "a\nb\n", " x\n\ty. z"]
    words = ["foo.", "bar,", "it's", "x\ny", "Z.\nA", "²,", "½.", "e\u0301.", "\n", "a.b", "..", "9.", "é,\nÉ.", "ǅ.", "ʰ,"]
    texts += [" ".join(r.choice(words) for _ in range(40)) for r in [random.Random(i) for i in range(30)]]
    enc = token_files.Encoder(PATH)
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    for t, raw in zip(texts * 2, enc.encode(pa.array([*texts, *texts])), strict=True):
        assert np.frombuffer(raw, enc.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_files_keep_every_row_in_order(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 2000)       # several shards
    monkeypatch.setattr(token_files, "INDEX_KEYS", 20)
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(60)]
    rows += [(5, "again"), (5, "again"), (7, None), (None, "no id"), (None, None), (-3, "ü" * 3000)]
    rows += [(9, f"one id in many shards {k} " * 9) for k in range(40)]
    docs = spark.createDataFrame([(t, i, 1) for i, t in rows], "text string, doc_id long, n long")
    token_files.write(docs, tmp_dir + "/t", PATH, 2)
    want = brute(rows)
    keys = token_files.directory(spark, tmp_dir + "/t")
    assert keys.select("shard").distinct().count() > 2
    got = token_files.lookup(spark, tmp_dir + "/t", keys.select("id", "rep")).collect()
    assert sorted((r.id, tuple(r.value)) for r in got if r.id is not None) == sorted(
        (i, tuple(want[i, t])) for i, t in rows if i is not None)
    assert len(got) == len(rows)
    assert len({(r.id, r.rep) for r in got}) == len(rows)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n
    ids = [r.id for r in sorted(got, key=lambda r: r.start)]
    assert ids == [None, None, *sorted(i for i in ids if i is not None)]
    some = spark.createDataFrame([(8, 0), (999, 0), (5, 2), (5, 9)], "id long, rep long")
    few = token_files.lookup(spark, tmp_dir + "/t", some, digest=True).collect()
    assert sorted((r.id, r.rep) for r in few) == [(5, 2), (8, 0)]
    ids8 = want[8, rows[8][1]]
    assert {r.id: r.value for r in few}[8] == zlib.crc32(np.array(ids8, "<u4").tobytes())


def test_added_tokens_as_the_plain_call_has_them(spark, tmp_dir):
    token = "<|endoftext|>"
    texts = [token, f"a{token}b", f" {token} ", f"a \n{token}\n b\n", f"x.\n{token}{token},\ny", f"a  b\t {token} it's",
             "<|endoftext| >", "plain text", "", None]
    tok = Tokenizer.from_file(PATH)
    want = {t: tok.encode(t or "", add_special_tokens=False).ids for t in texts}
    assert want[token] == [50256]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for literal in (False, True):
        path = f"{tmp_dir}/{literal}"
        token_files.write(docs, path, PATH, 2, **({"literal": True} if literal else {}))
        keys = token_files.directory(spark, path).select("id", "rep")
        got = {texts[r.id]: list(r.value) for r in token_files.lookup(spark, path, keys).collect()}
        if literal:
            assert 50256 not in sum(got.values(), []) and tok.decode(got[texts[1]][:-1]) == texts[1]
            want = {t: v for t, v in want.items() if token not in (t or "")}
            got = {t: got[t] for t in want}
        assert got == {t: [*v, 2] for t, v in want.items()}


def test_empty_table(spark, tmp_dir):
    docs = spark.createDataFrame([], "doc_id long, text string")
    token_files.write(docs, tmp_dir + "/e", PATH, 2)
    keys = token_files.directory(spark, tmp_dir + "/e")
    assert token_files.lookup(spark, tmp_dir + "/e", keys.select("id", "rep")).count() == 0
