"""Chat formatting by schema fingerprints.

The nested field paths of a layout (not their types or order) are hashed to a
fingerprint, and the fingerprint selects a declarative mapping: where the
turns are and what their roles and texts are called. A whole table is mapped
by the fingerprint of its schema; a column of JSON records of mixed layouts by
the fingerprint of each record. Paths that a layout does not know take no part
in its fingerprint. All layouts become the same canonical turns,
which one template renders. Everything is built-in functions.

Template, one piece per turn: ``<turn ROLE>``, a line feed, the text, a line
feed, ``</turn>``, a line feed. Inside a text, ``<turn`` and ``</turn`` get one
more backslash than they had in front, and reading takes one away, so no text
can open or close a turn, and every text is read back exactly. A role's
backslashes, ``>`` and line feeds are escaped; a null role is ``\\0``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, CLOSE = "<turn ", "</turn>\n"
LOSS_ROLE = "assistant"


@dataclass(frozen=True)
class Mapping:
    """How one layout holds its turns.

    ``items``: the path of an array of messages, or None. ``parts``: (role,
    text) pairs; the role is a literal if it begins with ``=``, else a path;
    paths are inside an item if there are items. Parts after the first whose
    text is null or empty in a record are no turns (an instruction without input).
    """
    items: str | None
    parts: tuple[tuple[str, str], ...]


#: Field paths of a layout, and its mapping.
LAYOUTS: dict[tuple[str, ...], Mapping] = {
    ("messages", "messages[].content", "messages[].role"): Mapping("messages", (("role", "content"),)),
    ("conversations", "conversations[].from", "conversations[].value"): Mapping("conversations", (("from", "value"),)),
    ("completion", "prompt"): Mapping(None, (("=user", "prompt"), ("=assistant", "completion"))),
    ("prompt", "response"): Mapping(None, (("=user", "prompt"), ("=assistant", "response"))),
    ("instruction", "output"): Mapping(None, (("=user", "instruction"), ("=assistant", "output"))),
    ("input", "instruction", "output"): Mapping(
        None, (("=user", "instruction"), ("=user", "input"), ("=assistant", "output"))),
    ("role", "text", "turn"): Mapping(None, (("role", "text"),)),
}
#: Roles by their names in other layouts.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant"}
#: The layout whose roles are canonical as they are.
NATIVE = ("role", "text", "turn")
LONGEST_FIRST = sorted(LAYOUTS, key=len, reverse=True)


def field_paths(data_type: T.DataType, at: str = "") -> list[str]:
    """Every nested field path of a type; ``[]`` marks the items of an array."""
    if isinstance(data_type, T.ArrayType):
        return field_paths(data_type.elementType, at + "[]")
    if isinstance(data_type, T.StructType):
        out = []
        for f in data_type.fields:
            path = f"{at}.{f.name}" if at else f.name
            out += [path, *field_paths(f.dataType, path)]
        return out
    return []


def path_text(paths) -> str:
    return "\n".join(sorted(set(paths)))


def path_hash(paths) -> str:
    """Fingerprint of field paths: a hash of them, sorted, one per line."""
    return hashlib.sha256(path_text(paths).encode()).hexdigest()


def fingerprint(paths: Column, layout: tuple[str, ...]) -> Column:
    """Like ``path_hash``, of those of an array of paths that the layout knows."""
    known = F.array_intersect(paths, F.array(*map(F.lit, layout)))
    return F.sha2(F.array_join(F.array_sort(known), "\n"), 256)


def canonical_role(role: Column) -> Column:
    return F.coalesce(*[F.when(role == a, F.lit(b)) for a, b in ROLE_NAMES.items()], role)


def record_paths(variant: Column) -> Column:
    """Field paths of each JSON record (two levels: fields, and fields of the
    messages in an array), from its own schema."""
    top = F.from_json(F.to_json(variant), "map<string,string>")
    names = F.map_keys(top)
    inner = F.flatten(F.transform(names, lambda k: F.when(
        F.substring(F.element_at(top, k), 1, 1) == "[",
        F.transform(F.array_distinct(F.flatten(F.transform(
            F.coalesce(F.from_json(F.element_at(top, k), "array<map<string,string>>"), F.array()),
            lambda m: F.map_keys(m)))), lambda f: F.concat(k, F.lit("[]."), f))
    ).otherwise(F.array().cast("array<string>"))))
    return F.array_distinct(F.concat(names, inner))


def turns_of(mapping: Mapping, value) -> Column:
    """Canonical turns (role, text) of one record; ``value(path)`` gives its fields."""
    def turn(get, role, text):
        name = F.lit(role[1:]) if role.startswith("=") else get(role).cast("string")
        return F.struct(name.alias("role"), F.coalesce(get(text).cast("string"), F.lit("")).alias("text"))

    if mapping.items is not None:
        (role, text), = mapping.parts
        return F.transform(value(mapping.items), lambda m: turn(lambda f: m[f], role, text))
    first, *rest = (turn(value, *p) for p in mapping.parts)
    kept = F.filter(F.array(first, *rest[:-1]), lambda t: t["text"] != "") if len(rest) > 1 else F.array(first)
    return F.concat(kept, F.array(rest[-1])) if rest else kept


def canonical_turns(df: DataFrame, record_id: str, *, order: str | None = None) -> DataFrame:
    """Turns (conv_id, turn, role, text) of a table of one layout, chosen by
    the fingerprint of its columns other than ``record_id``.

    With ``order`` a row is a turn, else a record. Columns no layout names may
    be present: layouts are tried with all their paths, the longest first.
    """
    columns = T.StructType([f for f in df.schema.fields if f.name != record_id])
    present = set(field_paths(columns))
    layout = next((p for p in LONGEST_FIRST if path_hash(present.intersection(p)) == path_hash(p)), None)
    if layout is None:
        raise ValueError(f"no layout has only fields of {sorted(present)}")
    turns = turns_of(LAYOUTS[layout], lambda f: F.col(f))
    position = F.col(order) if order else F.lit(0)
    rows = df.select(F.col(record_id).alias("conv_id"), position.cast("long").alias("at"),
                     F.posexplode(turns).alias("n", "t"))
    role = F.col("t.role")
    return rows.select("conv_id", (F.col("at") if order else F.col("n").cast("long")).alias("turn"),
                       (role if layout == NATIVE else canonical_role(role)).alias("role"), F.col("t.text").alias("text"))


def _layouts(df: DataFrame, record_id: str, json: str) -> DataFrame:
    """conv_id, v (the parsed record) and layout (its fingerprint, null if none is known)."""
    v = F.try_parse_json(F.col(json))
    rows = df.select(F.col(record_id).alias("conv_id"), v.alias("v")).withColumn("paths", record_paths(F.col("v")))
    return rows.withColumn("layout", F.coalesce(*[
        F.when(fingerprint(F.col("paths"), p) == path_hash(p), F.lit(path_hash(p))) for p in LONGEST_FIRST])).drop("paths")


def unmapped_records(df: DataFrame, record_id: str, json: str) -> DataFrame:
    """Records that ``canonical_turns_json`` gives no turns: conv_id and reason
    (``malformed``, also of null records, ``layout`` or ``empty``)."""
    rows = _layouts(df, record_id, json).withColumn("turns", _turns_by_layout())
    reason = F.when(F.col("v").isNull(), "malformed").when(F.col("layout").isNull(), "layout").when(
        F.coalesce(F.size("turns"), F.lit(0)) <= 0, "empty")
    return rows.select("conv_id", reason.alias("reason")).filter("reason is not null")


def canonical_turns_json(df: DataFrame, record_id: str, json: str) -> DataFrame:
    """Turns of JSON records of mixed layouts, each mapped by its own
    fingerprint. A record that is null, malformed or of no known layout has no
    turns; ``unmapped_records`` gives those."""
    rows = _layouts(df, record_id, json).select("conv_id", F.posexplode(_turns_by_layout()).alias("turn", "t"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), canonical_role(F.col("t.role")).alias("role"),
                       F.col("t.text").alias("text"))


def _turns_by_layout() -> Column:
    """Turns of ``v`` by the mapping that ``layout`` selects."""
    turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    for paths, mapping in LAYOUTS.items():
        if mapping.items is not None:
            def get(path):
                return F.try_variant_get("v", f"$.{path}", "array<map<string,string>>")
        else:
            def get(path):
                return F.try_variant_get("v", f"$.{path}", "string")
        turns = F.when(F.col("layout") == path_hash(paths), turns_of(mapping, get)).otherwise(turns)
    return turns


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\*</?turn)", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\*</?turn)", "$1")


def _role_out(role: Column) -> Column:
    r = F.replace(role, F.lit("\\"), F.lit("\\\\"))
    r = F.replace(F.replace(r, F.lit(">"), F.lit("\\g")), F.lit("\n"), F.lit("\\n"))
    return F.coalesce(r, F.lit("\\0"))


def _role_in(role: Column) -> Column:
    """Undoes ``_role_out``: what lies between escaped backslashes is read by itself."""
    between = F.transform(F.split(role, r"\\\\"), lambda r: F.replace(F.replace(r, F.lit("\\n"), F.lit("\n")), F.lit("\\g"), F.lit(">")))
    return F.when(role != "\\0", F.array_join(between, "\\"))


def format_chats(turns: DataFrame) -> DataFrame:
    """Renders canonical turns (conv_id, turn, role, text).

    One row per conv_id: formatted, the rendered conversation; starts, the
    position of each turn's piece in it; loss, for each turn the span of its
    text if the role is assistant, else null (code points, end exclusive).
    Turns are ordered by turn, then role, then text, so that repeated turns and
    rows have a defined order; a null turn number or role comes first, a null
    text is empty. A conversation is one row of the result, so its turns meet
    in one task, where positions run over a sort that can spill.
    """
    text = escaped(F.coalesce("text", F.lit("")))
    rows = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("raw"),
                        F.concat(F.lit(OPEN), _role_out(F.col("role")), F.lit(">\n")).alias("head"), text.alias("body"))
    piece = F.concat("head", "body", F.lit("\n" + CLOSE))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "raw")
    rows = rows.select(
        "conv_id", F.row_number().over(order).alias("n"), piece.alias("piece"),
        (F.sum(F.length(piece)).over(order.rowsBetween(W.unboundedPreceding, 0)) - F.length(piece)).alias("start"),
        F.when(F.col("role") == LOSS_ROLE, F.length("head")).alias("skip"), F.length("body").alias("size"))
    spans = F.when(F.col("skip").isNotNull(), F.struct((F.col("start") + F.col("skip")).alias("start"),
                                                       (F.col("start") + F.col("skip") + F.col("size")).alias("end")))
    gathered = rows.select("conv_id", F.struct("n", "piece", "start", spans.alias("loss")).alias("p")).groupBy(
        "conv_id").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    return gathered.select("conv_id", F.array_join("ps.piece", "").alias("formatted"),
                           F.col("ps.start").alias("starts"), F.col("ps.loss").alias("loss"))


def read_chats(chats: DataFrame) -> DataFrame:
    """Reads turns and loss texts back from the output of ``format_chats``.

    Adds turns, an array of (role, text), and loss_texts, the unescaped texts
    under the loss mask in order.
    """
    pieces = F.filter(F.split("formatted", r"(?<!\\)</turn>\n"), lambda p: p != "")
    turn = r"(?s)^<turn ([^>]*)>\n(.*)\n$"
    turns = F.transform(pieces, lambda p: F.struct(
        _role_in(F.regexp_extract(p, turn, 1)).alias("role"),
        unescaped(F.regexp_extract(p, turn, 2)).alias("text")))
    marked = F.arrays_zip(pieces.alias("piece"), F.col("starts").alias("start"), F.col("loss").alias("loss"))
    loss = F.transform(F.filter(marked, lambda m: m["loss"].isNotNull()), lambda m: unescaped(F.substring(
        m["piece"], (m["loss"]["start"] - m["start"] + 1).cast("int"), (m["loss"]["end"] - m["loss"]["start"]).cast("int"))))
    return chats.select("*", turns.alias("turns"), loss.alias("loss_texts"))
