r"""Chat formatting: layouts told apart by their schema, one canonical form, one template.

A record's or table's fingerprint is a hash of those of its nested field paths that
some layout knows. It selects a declarative mapping, a DataFrame expression that gives
canonical turns: ``array<struct<role, text>>``. Fingerprints of the layouts themselves
are in ``MAPPINGS``. Any other one is looked up once, by rule: the first layout all of
whose paths are there. Known fields that the layout doesn't take are named, not
dropped in silence: as a warning for a table, in ``layouts_json`` for a record.
Records in JSON are told apart one by one; elements of a list count together, so
one with a field missing hides no other, and texts, lists and objects under one name
are different paths. Records that fit no layout come back from ``unmatched_json``.

The template writes a turn as ``### role: text</turn>\n``. Control strings inside
texts are escaped with a backslash so that none is left, and come back when read:
``\`` as ``\e``, ``###`` as ``\h``, ``</turn>`` as ``\t``; in roles ``:`` as ``\c``.

Defined results: null texts and roles are empty; a null or empty list of turns
gives an empty string; turns with the same number are ordered by role, then text;
other columns are ignored, whatever their names. A conversation is one row of the
result, so its turns meet in one task; that is the size of one formatted string.
"""

from __future__ import annotations

import hashlib
import warnings
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK, SEP, END = "### ", ": ", "</turn>\n"
TURNS = "array<struct<role:string,text:string>>"


def paths(kind: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a type; ``[]`` steps into an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in paths(f.dataType, f"{at}.{f.name.lower()}" if at else f.name.lower())]
    if isinstance(kind, T.ArrayType):
        return paths(kind.elementType, f"{at}[]")
    return [at]


#: A column by its path: ``messages[]`` is the list, ``prompt`` the text.
Fields = Callable[[str], Column]


def _list_of(path: str, role: str, text: str) -> Callable[[Fields], Column]:
    return lambda of: F.transform(of(path), lambda x: F.struct(F.coalesce(x[role], F.lit("")).alias("role"), F.coalesce(x[text], F.lit("")).alias("text")))


def _fixed(*turns: tuple[str, tuple[str, ...]]) -> Callable[[Fields], Column]:
    """A turn of each (role, columns); columns are joined by blank lines, empty ones left out."""
    join = lambda of, names: F.array_join(F.filter(F.array(*map(of, names)), lambda x: x != ""), "\n\n")
    return lambda of: F.array(*(F.struct(F.lit(role).alias("role"), F.coalesce(join(of, names), F.lit("")).alias("text")) for role, names in turns))


def _then(*parts: Callable[[Fields], Column]) -> Callable[[Fields], Column]:
    return lambda of: F.concat(*(p(of) for p in parts))


_PROMPTS, _ANSWERS = _list_of("prompt[]", "role", "content"), _list_of("completion[]", "role", "content")
# The layouts that are known, most specific first: (name, field paths, mapping).
LAYOUTS: list[tuple[str, tuple[str, ...], Callable[[Fields], Column]]] = [
    ("messages", ("messages[].content", "messages[].role"), _list_of("messages[]", "role", "content")),
    ("from_value", ("conversations[].from", "conversations[].value"), _list_of("conversations[]", "from", "value")),
    ("prompts_completions", ("completion[].content", "completion[].role", "prompt[].content", "prompt[].role"), _then(_PROMPTS, _ANSWERS)),
    ("prompts_completion", ("completion", "prompt[].content", "prompt[].role"), _then(_PROMPTS, _fixed(("assistant", ("completion",))))),
    ("prompts_response", ("prompt[].content", "prompt[].role", "response"), _then(_PROMPTS, _fixed(("assistant", ("response",))))),
    ("prompts", ("prompt[].content", "prompt[].role"), _PROMPTS),
    ("instruction_input", ("input", "instruction", "output"), _fixed(("user", ("instruction", "input")), ("assistant", ("output",)))),
    ("instruction", ("instruction", "output"), _fixed(("user", ("instruction",)), ("assistant", ("output",)))),
    ("prompt_response", ("prompt", "response"), _fixed(("user", ("prompt",)), ("assistant", ("response",)))),
    ("prompt_completion", ("completion", "prompt"), _fixed(("user", ("prompt",)), ("assistant", ("completion",)))),
    ("question_answer", ("answer", "question"), _fixed(("user", ("question",)), ("assistant", ("answer",)))),
]
ROWS = ("role", "text", "turn")
PATHS = sorted({p for _, ps, _ in LAYOUTS for p in ps})
KNOWN = sorted({*PATHS, *ROWS})


def fingerprint(found: Iterable[str]) -> str:
    """Hash of those paths that some layout knows; others don't count."""
    return hashlib.sha256("\n".join(sorted(set(found) & set(KNOWN))).encode()).hexdigest()


#: Number of the layout by fingerprint; -1: a row is a turn.
MAPPINGS = {fingerprint(ROWS): -1} | {fingerprint(ps): i for i, (_, ps, _) in enumerate(LAYOUTS)}


def layout_of(found: Iterable[str]) -> int | None:
    """Number of the layout that the fingerprint of these paths selects; an unknown one is worked out and remembered. None: no layout."""
    held = set(found)
    mark = fingerprint(held)
    if mark not in MAPPINGS:
        fits = [i for i, ps in [(-1, ROWS), *((i, ps) for i, (_, ps, _) in enumerate(LAYOUTS))] if held.issuperset(ps)]
        if not fits:
            return None
        MAPPINGS[mark] = fits[0]
    return MAPPINGS[mark]


def canonical(df: DataFrame, key: str) -> DataFrame:
    """(key, turn, role, text) of a table in any known layout, selected by its schema's fingerprint.

    A table of one row a turn has columns turn, role and text. ValueError: no layout fits.
    Known fields that the layout doesn't take give a UserWarning with their names.
    """
    held = set(paths(df.schema))
    i = layout_of(held)
    if i is None:
        raise ValueError(f"no layout has the fields {sorted(held & set(KNOWN))}")
    if unused := sorted(held & set(KNOWN) - set(ROWS if i < 0 else LAYOUTS[i][1])):
        warnings.warn(f"layout {'turn rows' if i < 0 else LAYOUTS[i][0]} leaves out the fields {unused}", stacklevel=2)
    if i < 0:
        return df.select(key, F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")))
    turns = df.select(key, F.posexplode(LAYOUTS[i][2](lambda p: F.col(p.removesuffix("[]")))).alias("turn", "_t"))
    return turns.select(key, F.col("turn").cast("long").alias("turn"), "_t.role", "_t.text")


def _records(df: DataFrame, key: str, record: str) -> DataFrame:
    """Records with the fields that layouts know (a column for each path), the known paths they hold, their fingerprint and layout."""
    roots = {p.split(".")[0] for p in PATHS}
    v = df.select(F.col(key).alias("_key"), F.col(record).alias("_record"), F.try_parse_json(record).alias("_v"))
    fields, held = {}, {}
    for root in sorted(roots):
        name = root.removesuffix("[]")
        value = F.try_variant_get("_v", f"$.{name}", "variant")
        kind = F.schema_of_variant(value)
        if root == name:
            fields[root] = F.when(~kind.startswith("ARRAY") & ~kind.startswith("OBJECT"), F.coalesce(F.try_variant_get("_v", f"$.{name}", "string"), F.lit("")))
            held[root] = F.col(f"`{root}`").isNotNull()
        else:
            parts = [p.rpartition(".")[2] for p in PATHS if p.startswith(f"{root}.")]
            fields[root] = F.when(kind.startswith("ARRAY"), F.try_variant_get("_v", f"$.{name}", f"array<struct<{','.join(f'`{x}`:string' for x in parts)}>>"))
            held |= {f"{root}.{x}": F.coalesce(F.exists(F.col(f"`{root}`.`{x}`"), F.isnotnull), F.lit(False)) for x in parts}
    v = v.select("_key", "_record", *(c.alias(n) for n, c in fields.items()))
    v = v.withColumn("_held", F.array_compact(F.array(*(F.when(held[p], F.lit(p)) for p in PATHS))))
    v = v.withColumn("_mark", F.sha2(F.array_join("_held", "\n"), 256))
    # One row for each fingerprint that the records have: a few, as paths are a few.
    layout = F.coalesce(*(F.when(F.size(F.array_except(F.array(*map(F.lit, ps)), "_held")) == 0, F.lit(i)) for i, (_, ps, _) in enumerate(LAYOUTS)))
    known = v.select("_mark", "_held").distinct().select("_mark", layout.alias("_layout"))
    return v.join(known, "_mark")


def layouts_json(df: DataFrame, key: str, record: str) -> DataFrame:
    """One row a record: key, fingerprint, layout (null: none fits), fields (known paths that it holds), unused (those that its layout doesn't take), record."""
    name, taken = F.lit(None).cast("string"), F.array().cast("array<string>")
    for i, (n, ps, _) in enumerate(LAYOUTS):
        name, taken = F.when(F.col("_layout") == i, n).otherwise(name), F.when(F.col("_layout") == i, F.array(*map(F.lit, ps))).otherwise(taken)
    out = _records(df, key, record)
    return out.select(F.col("_key").alias(key), F.col("_mark").alias("fingerprint"), name.alias("layout"), F.col("_held").alias("fields"), F.array_except("_held", taken).alias("unused"), F.col("_record").alias("record"))


def unmatched_json(df: DataFrame, key: str, record: str) -> DataFrame:
    """The records that ``canonical_json`` gives no turns of for want of a layout, with their fingerprints."""
    return layouts_json(df, key, record).where("layout IS NULL")


def canonical_json(df: DataFrame, key: str, record: str) -> DataFrame:
    """(key, turn, role, text) of records in JSON, each by its own fingerprint; ``unmatched_json`` has those that fit no layout."""
    turns = F.lit(None).cast(TURNS)
    for i, (_, _, build) in enumerate(LAYOUTS):
        turns = F.when(F.col("_layout") == i, build(lambda p: F.col(f"`{p}`")).cast(TURNS)).otherwise(turns)
    rows = _records(df, key, record).select("_key", F.posexplode(turns).alias("turn", "_t"))
    return rows.select(F.col("_key").alias(key), F.col("turn").cast("long").alias("turn"), "_t.role", "_t.text")


def escape(c: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\e")), F.lit("###"), F.lit("\\h")), F.lit("</turn>"), F.lit("\\t"))
    return F.replace(out, F.lit(":"), F.lit("\\c")) if role else out


def unescape(c: Column, role: bool = False) -> Column:
    out = F.replace(c, F.lit("\\c"), F.lit(":")) if role else c
    return F.replace(F.replace(F.replace(out, F.lit("\\h"), F.lit("###")), F.lit("\\t"), F.lit("</turn>")), F.lit("\\e"), F.lit("\\"))


def format_turns(turns: DataFrame, key: str, learn: str = "assistant") -> DataFrame:
    """One row a key: ``formatted`` and ``loss_spans`` (start, length in code points of the texts of role ``learn``)."""
    head = F.concat(F.lit(MARK), escape(F.col("role"), role=True), F.lit(SEP))
    rows = turns.select(key, "turn", "role", head.alias("_head"), escape(F.col("text")).alias("_body"))
    rows = rows.withColumn("_piece", F.concat("_head", "_body", F.lit(END)))
    order = Window.partitionBy(key).orderBy("turn", "role", "_body")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length("_piece")).over(upto), F.lit(0)) + F.char_length("_head")
    rows = rows.select(key, F.row_number().over(order).alias("_n"), "_piece", F.when(F.col("role") == learn, F.struct(start.alias("start"), F.char_length("_body").cast("long").alias("length"))).alias("_span"))
    packed = F.array_sort(F.collect_list(F.struct("_n", "_piece", "_span")))
    out = rows.groupBy(key).agg(packed.alias("_all"))
    return out.select(
        key,
        F.array_join(F.transform("_all", lambda x: x["_piece"]), "").alias("formatted"),
        F.filter(F.transform("_all", lambda x: x["_span"]), lambda x: x.isNotNull()).alias("loss_spans"),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, read from the formatted string and unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, s["length"].cast("int")))), "")


def parse_turns(formatted: Column) -> Column:
    """Turns read back from a formatted string, texts unescaped."""
    pieces = F.filter(F.split(formatted, END), lambda p: p != "")

    def turn(p: Column) -> Column:
        at = F.instr(p, SEP)
        role = F.substring(p, F.lit(len(MARK) + 1), at - 1 - len(MARK))
        return F.struct(unescape(role, role=True).alias("role"), unescape(F.substring(p, at + len(SEP), F.char_length(p))).alias("text"))

    return F.transform(pieces, turn)
