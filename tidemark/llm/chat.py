"""Chats of several layouts as canonical turns, and turns as one formatted text with a loss mask.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The template: a turn is HEAD, its role, BREAK, its text and END.
HEAD, BREAK, END = "### ", ":\n", "</turn>\n"
#: What a text may not hold as it is, and what stands for it; the escape sign itself comes first.
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"), (":\n", "\\c"))


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns: a list with the names of role and text, single fields with the role of each, or a
    row per turn with the names of its number, role and text."""

    name: str
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str], ...] = ()
    number: str | None = None

    def names(self) -> set[str]:
        """Fields of the top level."""
        return {self.number, self.role, self.text} if self.number else {self.turns} if self.turns else {f for _, f in self.fields}

    def paths(self) -> str:
        """The layout's nested field paths, as :func:`paths_of` states them."""
        if self.number:
            return f"OBJECT<{', '.join(sorted(self.names()))}>"
        if self.turns:
            return f"OBJECT<{self.turns}: ARRAY<OBJECT<{', '.join(sorted((self.role, self.text)))}>>>"
        return f"OBJECT<{', '.join(sorted(field for _, field in self.fields))}>"


MAPPINGS = (
    Mapping("rows", number="turn", text="text"),
    Mapping("messages", turns="messages"),
    Mapping("from_value", turns="conversations", role="from", text="value"),
    Mapping("prompt_completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("prompt_response", fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("instruction", fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction_input", fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("system_instruction", fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"))),
)
#: Names of roles in other layouts.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
TURNS = "array<struct<role:string,text:string>>"


def fingerprint(paths: Column) -> Column:
    """Digest of a layout's nested field paths."""
    return F.sha2(paths, 256)


def paths_of(document: Column) -> Column:
    """Nested field names of a JSON value in sorted order, without the types of plain values; null if it is not JSON."""
    return F.regexp_replace(F.schema_of_variant(F.try_parse_json(document)), r": (?!ARRAY<|OBJECT<)[A-Z_]+(\([0-9, ]+\))?", "")


def turns_of(documents: DataFrame, column: str = "document", mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """``documents`` with ``layout`` and ``turns (role, text)`` from a column of JSON objects of any known layout.

    The fingerprint of a row's field paths selects its mapping.  Null, broken and
    unknown layouts get a null layout and no turns; a null text is empty; a fixed
    field that is empty gives no turn unless it is the answer.
    """
    mark = fingerprint(paths_of(F.col(column)))
    layout, turns = F.lit(None).cast("string"), F.array().cast(TURNS)
    for m in mappings:
        same = mark == fingerprint(F.lit(m.paths()))
        layout = F.when(same, F.lit(m.name)).otherwise(layout)
        turns = F.when(same, _mapped(F.col(column), m)).otherwise(turns)
    return documents.withColumn("layout", layout).withColumn("turns", turns)


def _mapped(document: Column, m: Mapping) -> Column:
    if m.number:
        parsed = F.from_json(document, f"`{m.role}` string, `{m.text}` string")
        return F.array(_turn(parsed[m.role], parsed[m.text])).cast(TURNS)
    if m.turns:
        return _listed(F.from_json(document, f"`{m.turns}` array<struct<`{m.role}`:string,`{m.text}`:string>>")[m.turns], m)
    parsed = F.from_json(document, ",".join(f"`{field}` string" for _, field in m.fields))
    return _single({field: parsed[field] for _, field in m.fields}, m)


def _listed(turns: Column, m: Mapping) -> Column:
    return F.coalesce(F.transform(turns, lambda t: _turn(_role(t[m.role]), t[m.text])).cast(TURNS), F.array().cast(TURNS))


def _single(values: dict[str, Column], m: Mapping) -> Column:
    each = F.array(*[_turn(F.lit(role), values[field]) for role, field in m.fields]).cast(TURNS)
    return F.filter(each, lambda t: (t["role"] == "assistant") | (t["text"] != ""))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _role(name: Column) -> Column:
    known = F.lower(F.trim(name))
    for other, role in ROLES.items():
        known = F.when(known == other, role).otherwise(known)
    return known


def escaped(text: Column) -> Column:
    """Text that holds no control string; :func:`unescaped` gives back exactly what it was."""
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def table_turns(table: DataFrame, key: str, mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """``(conversation, turn, role, text)`` from a table of any known layout, with a row per turn or per conversation.

    Fingerprints of the schema's nested paths select the mapping: that of the columns
    which a mapping names has to be the mapping's own.  Where several layouts are
    there, the one of most columns counts, then the first; ``key`` and all other
    columns do not count, whatever their names.  A table of unknown layout is
    refused.  Null role and text are empty; an empty table gives no turns.
    """
    def mark(paths: str) -> str:
        return sha256(paths.encode()).hexdigest()

    def there(m: Mapping) -> bool:
        used = T.StructType([f for f in table.schema.fields if f.name in m.names() and f.name != key])
        return mark(schema_paths(used)) == mark(m.paths())

    known = sorted(filter(there, mappings), key=lambda m: -len(m.names()))
    if not known:
        raise ValueError(f"no mapping for {schema_paths(table.schema)}")
    m = known[0]
    if m.number:
        found = table.select(F.col(key).alias("conversation"), F.col(m.number).cast("long").alias("turn"), _turn(F.col(m.role), F.col(m.text)).alias("t"))
        return found.select("conversation", "turn", "t.role", "t.text")
    turns = _listed(F.col(m.turns), m) if m.turns else _single({f: F.col(f).cast("string") for _, f in m.fields}, m)
    return _numbered(table.select(F.col(key).alias("conversation"), turns.alias("turns")))


def schema_paths(kind: T.DataType) -> str:
    """The nested field paths of a Spark schema, stated as :func:`paths_of` states those of a JSON value."""
    if isinstance(kind, T.StructType):
        return "OBJECT<" + ", ".join(f.name + (f": {inner}" if (inner := schema_paths(f.dataType)) else "")
                                     for f in sorted(kind.fields, key=lambda f: f.name)) + ">"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{schema_paths(kind.elementType)}>"
    return ""


def _numbered(found: DataFrame) -> DataFrame:
    return found.select("conversation", F.posexplode("turns").alias("turn", "t")).select(
        "conversation", F.col("turn").cast("long").alias("turn"), "t.role", "t.text")


def document_turns(documents: DataFrame, key: str, column: str = "document", mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """The same from JSON documents; a document without turns gives no row."""
    return _numbered(turns_of(documents.select(F.col(key).alias("conversation"), F.col(column).alias("document")), "document", mappings))


def formatted(turns: DataFrame) -> DataFrame:
    """``(conversation, formatted, loss)`` from :func:`table_turns` or :func:`document_turns`, one row per conversation.

    Turns follow each other by turn, role and text; a null turn comes first, and
    turns without a conversation form one of their own.  ``loss`` holds the spans
    ``(first, length)`` in code points of the assistant's texts, as they stand in
    ``formatted``.  Repeated rows are repeated turns.  An empty table gives no row.
    A conversation's turns meet in one task, as its text is one value.
    """
    head = F.concat(F.lit(HEAD), escaped(F.col("role")), F.lit(BREAK))
    order = Window.partitionBy("conversation").orderBy("turn", "role", "text")
    pieces = (turns.withColumn("head", head).withColumn("body", escaped(F.col("text")))
              .select("conversation", "turn", "role", "text", F.concat("head", "body", F.lit(END)).alias("piece"),
                      F.length("head").alias("before"), F.length("body").alias("size")))
    placed = pieces.withColumn("start", F.coalesce(F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    gathered = placed.groupBy("conversation").agg(F.array_sort(F.collect_list(F.struct(
        "start", "piece", (F.col("start") + F.col("before")).alias("first"), "size", (F.col("role") == "assistant").alias("learn")))).alias("all"))
    return gathered.select("conversation", F.array_join("all.piece", "").alias("formatted"),
                           F.transform(F.filter("all", lambda p: p["learn"]),
                                       lambda p: F.struct(p["first"].alias("first"), p["size"].cast("long").alias("length"))).alias("loss"))


def parsed_turns(text: Column) -> Column:
    """The turns of a formatted text."""
    pieces = F.split(text, END.replace("/", "\\/"))
    heads = F.filter(pieces, lambda p: p.startswith(HEAD))
    at = lambda p: F.instr(p, F.lit(BREAK))
    return F.transform(heads, lambda p: F.struct(
        unescaped(F.substr(p, F.lit(len(HEAD) + 1), at(p) - len(HEAD) - 1)).alias("role"),
        unescaped(F.substr(p, at(p) + len(BREAK))).alias("text")))


def under_loss(text: Column, loss: Column) -> Column:
    """The unescaped text under a loss mask, span after span."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substr(text, s["first"].cast("int") + 1, s["length"].cast("int")))), "")
