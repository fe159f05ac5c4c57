import html
import random
import re
import time

import numpy as np

from featuremap.llm import _lstm, html_text

SF = "/root/testdata/sf0.01"


def main_text(source):
    body = re.search(r"<article>(.*)</article>", source, re.S)[1]
    blocks = re.split(r"<p>(?:<b>)?|</p>|<h1>|</h1>|<br>", body)
    return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


def test_whole_pages_and_held_out_accuracy(spark):
    pages = spark.read.parquet(SF + "/pages.parquet")
    weights = html_text.train(pages.filter("page_id % 2 = 0"))
    odd = pages.filter("page_id % 2 = 1")
    got = {r.page_id: r.text for r in html_text.extract(odd, weights).collect()}
    want = {r.page_id: main_text(r.html) for r in odd.collect()}
    assert sum(got[i] == want[i] for i in want) == len(want)


def without(source, tags):
    return re.sub(rf"(</?)(?:{tags})\b", r"\1div", source)


def test_held_out_pages_without_semantic_tags(spark):
    pages = spark.read.parquet(SF + "/pages.parquet")
    weights = html_text.train(pages.filter("page_id % 2 = 0"))
    odd = pages.filter("page_id % 2 = 1").collect()
    for tags in ("article|main", "article|main|nav|footer|aside|header|section"):
        df = spark.createDataFrame([(r.page_id, r.url, without(r.html, tags)) for r in odd], pages.schema)
        got = {r.page_id: r.text for r in html_text.extract(df, weights).collect()}
        assert sum(got[r.page_id] == main_text(r.html) for r in odd) == len(odd), tags


def test_markup_that_is_not_clean(spark):
    page = html_text._Page(
        "<html><head><title>no</title></head><body><nav><li>menu<li>more</nav>"
        "<article><h1>A &amp b</h1><p>one <b>two<br>three\n\t four<p class=x>five &lt;p&gt;<!-- <p>no -->six"
        "<script>var a='</p>';</script><div class='comments'><p>reader</p></div></article></p>tail < 3 </bogus>")
    assert page.texts == ["menu", "more", "A & b", "one two three four", "five <p>six", "reader", "tail < 3"]
    assert page.labels == [False, False, True, True, True, False, False]
    assert html_text._Page("").texts == [] and html_text._Page("<script>never closed").texts == []
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<p>x"), (4, "u", "<p>" * 20_000 + "deep"),
            (5, "u", "<div>" * 3000 + "a" * 100_000)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    out = html_text.extract(df).collect()
    assert len(out) == len(rows) and all(r.text is not None for r in out)
    assert html_text.extract(df.limit(0)).count() == 0


def test_head_and_body_without_end_tags(spark):
    page = html_text._Page("<html><head><title>t</title><body><article><p>text")
    assert page.texts == ["text"] and page.labels == [True]
    for start in ("<p>", "<b>", "<br>", "<img src=x>", "<div>", "<head><p>", "<html><p>", ""):
        page = html_text._Page(
            "<head><meta name=a><link rel=b><title>t</title><style>s</style>\n<template><p>no</p></template>"
            "<noscript><p>no</noscript><script>no</script>" + start + "one<p>two")
        assert " ".join(page.texts) == "one two", start
    article = "".join(f"<p>Sentence {i} of a text that is long enough to be kept.</p>" for i in range(5))
    whole = ("<html><head><title>t</title></head><body><nav><a href=x>menu</a></nav><article>" + article
             + "</article></body></html>")
    bare = re.sub("</head>|</body>|</html>", "", whole)
    df = spark.createDataFrame([(i, "u", p) for i, p in enumerate([whole, bare])], "page_id long, url string, html string")
    one, two = (r.text for r in html_text.extract(df).orderBy("page_id").collect())
    assert one == two and "Sentence 4" in two


def test_stray_quotes():
    texts = lambda s: html_text._Page(s).texts
    assert texts("<p title=Bob's>one</p><p>it's two</p><p>three</p>") == ["one", "it's two", "three"]
    assert texts('<img alt="5" tall"><p>first para</p><p class="x">second') == ["first para", "second"]
    for tag in ("<p '>", '<p ">', "<p a=b'c\">", "<p it's a=1>", "<p a='x' '>", "<p a=\"x\"y'z>", "<p =\">", "<p a==\">",
                "<p a=>", "<p a= >", "<p/a='/'>", "<p a / = \">", "<p title=\"it's > one\">", "<p title = 'a \"> b'>",
                "<p\n title\t=\n'>'\n>", "<p a='>'b='>'>", "<p a=x/>"):
        assert texts(f"{tag}one</p '><p>it's \"two</p><p>three") == ["one", "it's \"two", "three"], tag
    for quote in "'\"":              # a value that is never closed ends with its tag
        assert texts(f"<p>one</p><p class={quote}x>two</p><p>three") == ["one", "two", "three"]


#: the rule of the scanner as one pattern, with quadratic time on tags that are not closed
RULE = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[ \t\n\f\r/]++|{html_text._ATTRIBUTE})*+)>|<[!?][^>]*>", re.S)


def tokens(source):
    markup, at, out = html_text._Markup(source), 0, []
    while (found := markup.next(at)) is not None:
        out.append(found)
        at = found[1]
    return out


def ruled(source):
    return [(m.start(), m.end(), m[1] or "", (m[2] or "").lower(), m[3] or "") for m in RULE.finditer(source)]


def test_scanner_follows_the_rule(spark):
    r = random.Random(3)
    for _ in range(20_000):
        source = "".join(r.choice(["<", "<a", "</b", " ", "/", "=", "='", '="', "'", '"', ">", "x", "<!", "<!--", "-->", "\v"])
                         for _ in range(r.randint(1, 40)))
        assert tokens(source) == ruled(source), source
    for row in spark.read.parquet(SF + "/pages.parquet").collect():
        assert tokens(row.html) == ruled(row.html)


def test_markup_of_a_megabyte_that_is_never_closed():
    for unit in ("<a ", "<a", "<a x='", '<p x="', "<!", "<?", "<!--", "</", "</a ", "<a x='>' ", "<p/a=", "<p a=b/", "<a =\"'",
                 "<script", "<title></title ", "=", "<a x=\">\" y='>'", "<p>", "<p class=x>a"):
        begin = time.perf_counter()
        page = html_text._Page(unit * ((1 << 20) // len(unit)))
        assert time.perf_counter() - begin < 20, unit
        assert page.texts or "<!-" in unit or unit in ("<p>", "<script", "<title></title ")


def test_gradient():
    r = np.random.default_rng(1)
    x, size = r.normal(size=(60, 4)).astype(np.float32), np.array([10, 0, 30, 20])
    first = np.cumsum(size) - size
    y = np.zeros(60, np.float32)
    for f, n in zip(first, size, strict=True):      # a label that needs the neighbour on the right
        y[f:f + n - 1] = x[f + 1:f + n, 0] > 0
    p = _lstm.train(x, y, first, size, hidden=12, epochs=300, rate=0.02)
    assert ((_lstm.predict(p, x, first, size) > 0) == (y > 0.5)).mean() > 0.95
