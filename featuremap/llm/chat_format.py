"""Chat formatting with schema fingerprints (DataFrame functions only).

Records of unlike layouts arrive as JSON.  The nested field paths of a record
are hashed; the hash selects a declarative mapping into canonical turns
(role, text).  A mapping is data: the shapes it accepts and the paths its turns
come from.  Canonical turns are written with turn marks; control strings inside
a text are escaped by one more backslash between ``<`` and ``|``, so the marks
are unambiguous and every text comes back exactly.

Defined results: a record that is null, no JSON or of an unknown shape keeps its
row with null ``layout``, ``turns`` and ``formatted``; a record of more than ``LARGE``
bytes that Spark can't parse (no JSON, or beyond the size of its variant type, 128 MiB)
raises, so that no long conversation turns into nulls; a null text is an empty
text, a null role an empty role; no turns give an empty string; ties in the turn
number are ordered by role and text; rows without a conversation id are one-turn
conversations of their own; other columns are kept by every step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
LARGE = 16 << 20
TURNS = "array<struct<role:string,text:string>>"
#: layout -> accepted field paths (per optional part), and where the turns come from.
#: ``each`` reads a list: (path, role field, text field, role names to replace);
#: ``fields`` reads single fields in order: (role, paths joined by a blank line).
LAYOUTS = {
    "messages": {
        "shapes": ["messages[].content,messages[].role"],
        "each": ("messages", "role", "content", {})},
    "conversations": {
        "shapes": ["conversations[].from,conversations[].value"],
        "each": ("conversations", "from", "value", {"human": "user", "gpt": "assistant"})},
    "instruction": {
        "shapes": ["instruction,output", "input,instruction,output", "instruction,output,system",
                   "input,instruction,output,system"],
        "fields": (("system", ("system",)), ("user", ("instruction", "input")),
                   ("assistant", ("output",)))},
    "prompt": {
        "shapes": ["prompt,response", "prompt,response,system"],
        "fields": (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))},
    "chat_prompt": {
        "shapes": ["completion,prompt[].content,prompt[].role"],
        "each": ("prompt", "role", "content", {}),
        "then": (("assistant", ("completion",)),)},
}


def field_paths(record: Column) -> Column:
    """The nested field paths of a JSON record, sorted, as one string; types of the
    leaves don't matter.  Null where the record is no JSON; above ``LARGE`` bytes that raises."""
    parsed = F.when(F.octet_length(record) > LARGE, F.parse_json(record)).otherwise(F.try_parse_json(record))
    shape = F.schema_of_variant(parsed)
    shape = F.regexp_replace(shape, r"(?<=: |<)[A-Z_]+(\([0-9,]*\))?(?=[,>]|$)", "")
    return shape


def _shape(paths: str) -> str:
    """What :func:`field_paths` says for a comma-separated list of paths."""
    tree: dict = {}
    for path in paths.split(","):
        at = tree
        for name in path.split("."):
            at = at.setdefault(name, {})

    def text(node: dict) -> str:
        out = []
        for name, inner in sorted(node.items()):
            value = text(inner) if inner else ""
            out.append(f"{name.removesuffix('[]')}: " + (f"ARRAY<{value}>" if name.endswith("[]") else value))
        return f"OBJECT<{', '.join(out)}>"

    return text(tree)


def fingerprint(record: Column) -> Column:
    return F.xxhash64(field_paths(record))


def _get(record: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.try_parse_json(record), f"$.{path}", kind)


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _fields(record: Column, fields) -> Column:
    turns = []
    for role, paths in fields:
        parts = [_get(record, p) for p in paths]
        main = F.coalesce(parts[0], F.lit(""))
        for more in parts[1:]:
            main = F.when(F.coalesce(more, F.lit("")) != "", F.concat(main, F.lit("\n\n"), more)).otherwise(main)
        turn = F.struct(F.lit(role).alias("role"), main.alias("text"))
        # an optional field that is missing gives no turn; user and assistant always do
        turns.append(F.when(parts[0].isNotNull() | F.lit(role != "system"), turn))
    return F.filter(F.array(*turns), lambda t: t.isNotNull())


def _mapped(record: Column, layout: dict) -> Column:
    if "fields" in layout:
        return _fields(record, layout["fields"])
    path, role, text, names = layout["each"]
    items = F.coalesce(_get(record, path, f"array<struct<`{role}`:string,`{text}`:string>>"),
                       F.array().cast(f"array<struct<`{role}`:string,`{text}`:string>>"))

    def one(x: Column) -> Column:
        name = x[role]
        for old, new in names.items():
            name = F.when(x[role] == old, F.lit(new)).otherwise(name)
        return _turn(name, x[text])

    turns = F.transform(items, one)
    return F.concat(turns, _fields(record, layout["then"])) if "then" in layout else turns


def canonical_turns(df: DataFrame, record: str = "record", layouts: dict = LAYOUTS) -> DataFrame:
    """``df`` with ``layout`` and ``turns`` in place of columns of these names."""
    col = F.col(f"`{record}`")
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    found = fingerprint(col)
    for key, layout in layouts.items():
        name = F.when(found.isin(*[F.xxhash64(F.lit(_shape(s))) for s in layout["shapes"]]),
                      F.lit(key)).otherwise(name)
    df = df.withColumn("layout", name)
    for key, layout in layouts.items():
        turns = F.when(F.col("layout") == key, _mapped(col, layout).cast(TURNS)).otherwise(turns)
    return df.withColumn("turns", turns)


def records_of_rows(df: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """(id, turns) of a table with one row per turn."""
    rows = df.select(F.col(id).alias("id"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("t"))
    strip = lambda a: F.transform(a, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    grouped = (rows.filter("id is not null").groupBy("id")
               .agg(F.sort_array(F.collect_list("t")).alias("a")))
    alone = rows.filter("id is null").select("id", F.array("t").alias("a"))
    return grouped.unionByName(alone).select(F.col("id").alias(id), strip(F.col("a")).alias("turns"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def format_turns(df: DataFrame, turns: str = "turns", loss_role: str = "assistant") -> DataFrame:
    """``df`` with ``formatted`` and ``loss`` (array of start and length in code
    points: the texts of ``loss_role``) in place of ``turns``."""
    # role and text as they are written; a role is percent-encoded, so it has no line break
    written = F.transform(F.col(turns), lambda t: F.struct(
        F.url_encode(t["role"]).alias("role"), escape(t["text"]).alias("text"),
        (t["role"] == loss_role).alias("loss")))
    df = df.withColumn(turns, written)
    line = lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END))
    empty = F.array().cast("array<struct<start:bigint,length:bigint>>")

    def add(a: Column, t: Column) -> Column:
        begin = a["at"] + len(START) + F.length(t["role"]) + 1
        size = F.length(t["text"]).cast("long")
        spans = F.when(t["loss"], F.concat(a["spans"], F.array(
            F.struct(begin.alias("start"), size.alias("length"))))).otherwise(a["spans"])
        return F.struct((begin + size + len(END)).alias("at"), spans.alias("spans"))

    first = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))
    return (df.withColumn("formatted", F.array_join(F.transform(F.col(turns), line), ""))
            .withColumn("loss", F.aggregate(F.col(turns), first, add, lambda a: a["spans"]))
            .drop(turns))


def read_turns(df: DataFrame, formatted: str = "formatted") -> DataFrame:
    """``df`` with ``turns`` parsed from the formatted text."""
    parts = F.split(F.col(formatted), r"<\|im_start\|>")
    parts = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))

    def one(x: Column) -> Column:
        role = F.substring_index(x, "\n", 1)
        skip = F.length(role) + 1
        text = F.substring(x, skip + 1, F.length(x) - skip - len(END))
        return F.struct(F.url_decode(role).alias("role"), unescape(text).alias("text"))

    return df.withColumn("turns", F.transform(parts, one))


def loss_text(formatted: str = "formatted", loss: str = "loss") -> Column:
    """All text under the loss mask as it was before escaping."""
    return F.array_join(F.transform(F.col(loss), lambda s: unescape(F.substring(
        F.col(formatted), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
