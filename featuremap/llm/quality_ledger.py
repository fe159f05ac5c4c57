"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once per document.  The ledger stores the measurements
and one ``fail_bits`` long with a bit per failed rule.  A policy is a named,
versioned set of rules, that is a mask; applying any policy, comparing versions
and measuring what each rule removes are bitwise operations on the stored
ledger and never read a text again.

Defined results: a null text is an empty text (no words, so it fails
``few_words``); every input row gives one ledger row, repeated ids included;
a null id is carried through; other columns of the input are ignored by
:func:`ledger` and kept unchanged by :func:`keep`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[ \t-\r]+"
WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_bangs", "n_upper")


#: (bit, name, condition under which a document fails); a bit is never reused
RULES = (
    (0, "few_words", "n_words < 10"),
    (1, "repeated_words", "100 * n_repeat_words > 20 * n_words"),
    (2, "symbols", "100 * n_symbols > 20 * n_words"),
    (3, "shouting", "word_chars >= 20 and 100 * n_upper > 50 * word_chars"),
    (4, "exclamations", "100 * n_bangs > 50 * n_words"),
    (5, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    (6, "long_words", "word_chars > 40 * n_words"),
)
BITS = {name: 1 << bit for bit, name, _ in RULES}
BASE = ("few_words", "repeated_words")
#: policy version -> rules that reject a document
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "shouting", "exclamations"),
    "strict": tuple(BITS),
}


def mask(policy: str | tuple[str, ...], policies: dict = POLICIES) -> int:
    names = policies[policy] if isinstance(policy, str) else policy
    return sum(BITS[n] for n in set(names))


def _length_of(text: Column, drop: str) -> Column:
    return F.length(F.regexp_replace(text, drop, "")).cast("long")


def _repeated_words(order: str) -> Column:
    """Words covered by a window that occurs twice; ``order`` has the windows
    sorted by hash, so equal ones are neighbours."""
    hit = F.filter(F.col(order), lambda x, i: (
        F.coalesce(F.get(F.col(order), i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(F.col(order), i + 1)["h"] == x["h"], F.lit(False))))
    at = F.sort_array(F.transform(hit, lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        at, start,
        lambda a, p: F.struct(
            (p + WINDOW).alias("end"),
            (a["n"] + WINDOW - F.greatest(F.lit(0), a["end"] - p)).cast("long").alias("n")),
        lambda a: a["n"])


def _measured(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """``row`` (a struct of the columns ``carry``) and the measurements.  Each step drops
    what the next ones don't need: the lines before the words are split, the text with
    the words, the words with their hashes, those with the windows'."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    df = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"), t.alias("t"))
    found = ["row", "n_symbols", "n_bangs", "n_upper"]
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    df = df.select(
        "row", "t", lines.alias("l"),
        _length_of(F.col("t"), r"[^#*$%&|<>]+").alias("n_symbols"),
        _length_of(F.col("t"), r"[^!]+").alias("n_bangs"),
        _length_of(F.col("t"), r"[^\p{Lu}]+").alias("n_upper"))
    df = df.select(*found, "t", F.size("l").cast("long").alias("n_lines"),
                   (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"))
    found += ["n_lines", "n_dup_lines"]
    bare = F.btrim(F.col("t"), F.lit(SPACE))
    df = df.select(*found, F.when(bare != "", F.split(bare, SPACES)).otherwise(
        F.array().cast("array<string>")).alias("w"))
    df = df.select(*found, F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
                   F.size("w").cast("long").alias("n_words"),
                   F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    found += ["word_chars", "n_words"]
    h = F.col("h")
    grams = F.transform(
        F.sequence(F.lit(0), F.size("h") - WINDOW),
        lambda i: F.xxhash64(*[h[i + j] for j in range(WINDOW)]))
    df = df.select(*found, F.when(F.size("h") > WINDOW, grams).otherwise(
        F.array().cast("array<long>")).alias("g"))
    # only a text with some repeated window pays for the sort
    some = F.size(F.array_distinct("g")) < F.size("g")
    order = F.sort_array(F.transform(
        "g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.select(*found, F.when(some, order).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>")).alias("o"))
    df = df.withColumn("n_repeat_words", _repeated_words("o"))
    # as a generator's output, so that a later filter on a measurement is not pushed
    # down as a second copy of all the work that leads to it
    return df.select("row", F.inline(F.array(F.struct(*MEASURES))))


def _bits() -> Column:
    out = F.lit(0).cast("long")
    for bit, _, sql in RULES:
        out = out.bitwiseOR(F.when(F.expr(sql), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return out


def ledger(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, the measurements and ``fail_bits`` of every row."""
    return (_measured(docs, text, [id]).withColumn("fail_bits", _bits())
            .select(F.col("row")[id].alias(id), *MEASURES, "fail_bits"))


def store(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ledger of ``docs`` to ``path``/ledger and, from there, its ablation to
    ``path``/ablation; the stored ledger."""
    spark = docs.sparkSession
    ledger(docs, id, text).write.parquet(f"{path}/ledger")
    book = spark.read.parquet(f"{path}/ledger")
    ablation(book).write.parquet(f"{path}/ablation")
    return book


def apply_policy(book: DataFrame, policy: str | tuple[str, ...] = "v1") -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    return book.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0)


def keep(docs: DataFrame, policy: str | tuple[str, ...] = "v1", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the policy, columns unchanged."""
    ok = _bits().bitwiseAND(F.lit(mask(policy))) == 0
    return _measured(docs, text, docs.columns).filter(ok).select("row.*")


def ablation(book: DataFrame, policies: dict = POLICIES) -> DataFrame:
    """Per policy and rule: rows the rule fails, rows only it rejects, and rows
    kept with and without it.

    One aggregation by ``fail_bits`` (at most 2^rules groups, combined map-side);
    all policies are then compared on those groups.
    """
    groups = book.groupBy("fail_bits").agg(F.count("*").alias("n"))
    plan = [(p, name, mask(p, policies), BITS[name]) for p in policies for name in policies[p]]
    cases = F.explode(F.array(*[
        F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(m).cast("long").alias("m"),
                 F.lit(b).cast("long").alias("b")) for p, r, m, b in plan])).alias("c")
    bad = F.col("fail_bits").bitwiseAND(F.col("c.m"))
    total = lambda ok: F.coalesce(F.sum(F.when(ok, F.col("n"))), F.lit(0))
    return (groups.select("fail_bits", "n", cases)
            .groupBy(F.col("c.policy").alias("policy"), F.col("c.rule").alias("rule"))
            .agg(total(bad.bitwiseAND(F.col("c.b")) != 0).alias("n_failed"),
                 total(bad == F.col("c.b")).alias("n_only"),
                 total(bad == 0).alias("n_kept"),
                 total((bad == 0) | (bad == F.col("c.b"))).alias("n_kept_without")))
