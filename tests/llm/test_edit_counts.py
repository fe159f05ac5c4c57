import random

import public_tokenizers

from featuremap.llm import edit_counts
from featuremap.llm.byte_bpe import encoding

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_trees_follow_random_edits():
    r, enc = random.Random(11), encoding(PATH)
    count = lambda ps: [len(enc.encode_ordinary(p)) for p in ps]
    word = lambda: "".join(r.choice("abcsétll''12.,!_[ \n\t漢。、　\x1c\u2019д") for _ in range(r.randint(0, 30)))
    for size in (0, 3, 600, 6000):
        text = "".join(word() + " " for _ in range(size // 16))
        pieces = edit_counts.cut(text)
        assert "".join(pieces) == text
        tree = edit_counts.Tree.build([(len(p), n) for p, n in zip(pieces, count(pieces), strict=True)])
        assert tree.tokens[0] == len(enc.encode_ordinary(text))
        for _ in range(60):
            a = r.randint(0, len(text))
            b = min(len(text), a + r.choice([0, 0, 1, 5, 700, 5000]))
            new = r.choice(["", " ", "x", word(), word() * 100])
            want = text[:a] + new + text[b:]
            text, again = tree.edit(text, a, b, new, count)
            assert text == want
            assert again <= len(new) + 8 * edit_counts.LEAF
            assert tree.tokens[0] == len(enc.encode_ordinary(text))
            assert tree.chars[0] == len(text)


def test_borders_are_pre_token_borders():
    import regex

    kinds = edit_counts._SPACES, edit_counts._LETTERS, edit_counts._DIGITS, edit_counts._MARKS
    rules = r"\s", r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}']"
    for kind, rule in zip(kinds, rules, strict=True):
        some = [chr(c) for c in range(0xD800) if regex.match(f"[{kind}]", chr(c))]
        assert some and all(regex.match(rule, c) for c in some), rule
    r, enc = random.Random(2), encoding(PATH)
    for _ in range(3000):
        text = "".join(r.choice("abstre'' \n\t01.!_漢字。　\xa0д\x1c") for _ in range(r.randint(2, 60)))
        for m in edit_counts._BORDER.finditer(text):
            parts = [*enc.encode_ordinary(text[:m.start()]), *enc.encode_ordinary(text[m.start():])]
            assert parts == enc.encode_ordinary(text), (text, m.start())


def test_an_edit_stays_small_without_blanks():
    r, enc = random.Random(9), encoding(PATH)
    count = lambda ps: [len(enc.encode_ordinary(p)) for p in ps]
    chinese = "".join("".join(chr(r.randint(0x4E00, 0x9FA5)) for _ in range(r.randint(3, 30))) + r.choice("。，！")
                      for _ in range(6000))
    rows = "\n".join("\t".join(f"{r.randint(0, 10 ** 6)}" for _ in range(6)) for _ in range(3000))
    code = "".join(f"function f{i}(a,b){{return a[{i}]+b.c{i};}}" for i in range(3000))
    for text in (chinese, rows, code):
        pieces = edit_counts.cut(text)
        assert len(pieces) > len(text) / edit_counts.LEAF / 2 and "".join(pieces) == text
        tree = edit_counts.Tree.build([(len(p), n) for p, n in zip(pieces, count(pieces), strict=True)])
        for at in (0, len(text) // 2, len(text) - 3):
            text, again = tree.edit(text, at, at + 2, "漢x1", count)
            assert again < 3 * edit_counts.LEAF
        assert tree.tokens[0] == len(enc.encode_ordinary(text))


def test_rows_nulls_and_extra_columns(spark):
    rows = [(1, "some words " * 300, 5), (1, "some words " * 300, 5), (2, None, 6), (3, "", 7), (None, "x y", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    counted = edit_counts.build(docs, PATH)
    edits = spark.createDataFrame(
        [(1, 1, 5, 10, None), (1, 0, 0, 0, "ab "), (2, 0, 3, 9, "new"), (3, 0, None, 2, "no")],
        "doc_id long, seq int, start int, end int, text string")
    out = edit_counts.edit(edit_counts.attach(counted, edits), PATH)
    assert out.columns == ["doc_id", "text", "tree", "n_tokens", "n_chars_encoded"]
    got = sorted(((r.doc_id, r.text, r.n_tokens) for r in out.collect()), key=str)
    one = "ab " + "some words " * 300
    one = one[:5] + one[10:]
    n = lambda t: len(encoding(PATH).encode_ordinary(t))
    assert got == sorted([(1, one, n(one)), (1, one, n(one)), (2, "new", n("new")), (3, "", 0),
                          (None, "x y", 2)], key=str)
    assert edit_counts.edit(edit_counts.attach(counted.limit(0), edits), PATH).count() == 0


def test_query_counts_like_the_library(spark):
    from featuremap.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r for r in spark.read.parquet(sf + "/documents.parquet").collect()}
    enc = encoding(PATH)
    for r in queries.QUERIES["op4_edit_counts"](spark, sf).collect():
        d = docs[r.doc_id]
        text = f"[{d.source}] {d.text}"
        half = len(text) // 2
        text = text[:half] + text[half + 17:] + f"\n{d.lang}"
        assert (r.n_tokens_before, r.n_tokens) == (len(enc.encode_ordinary(d.text)), len(enc.encode_ordinary(text)))
