"""Chat formatting by schema fingerprints (DataFrame functions only).

A record is one JSON object.  Its nested field paths, read from the schema of
its variant value without the scalar types, are hashed to a fingerprint, and
the fingerprint selects a declarative mapping that turns the record's layout
(messages, conversations, instruction or prompt fields) into canonical turns
``array<struct<role, text>>``.  A record of another fingerprint is matched by the
hash of those of its field paths that a layout needs, so further fields change
nothing.  A template then renders the turns; control strings inside texts are
escaped, so the output can be read back exactly.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS_TYPE = "array<struct<role:string,text:string>>"
#: Reads texts beyond the parser's default of 20,000,000 characters.
ANY_LENGTH = {"maxStringLen": str(2**31 - 1)}


# --------------------------------------------------------------- layouts

@dataclass(frozen=True)
class MessageList:
    """A list of message objects under ``field``, or the list of one named field."""

    field: str
    role: str
    text: str
    optional: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def structures(self) -> list[str]:
        keys = (self.role, self.text)
        return [_object({self.field: f"ARRAY<{_object(dict.fromkeys((*keys, *extra)))}>"}) for extra in _subsets(self.optional)]

    def needs(self) -> list[list[str]]:
        """Sets of field paths, each enough for this layout; texts may be lists of parts, or the list of messages empty."""
        role, text = f"{self.field}[].{self.role}", f"{self.field}[].{self.text}"
        return [[role, text], [role, f"{text}[]"], [role, text, f"{text}[]"], [f"{self.field}[]"]]

    def _items(self, record: Column) -> Column:
        return F.from_json(record, f"{self.field} array<struct<{self.role}:string,{self.text}:string>>", ANY_LENGTH)[self.field]

    def _turn(self, m: Column, text: Column) -> Column:
        return F.struct(_renamed(m[self.role], self.roles).alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    def turns(self, record: Column) -> Column:
        return F.transform(self._items(record), lambda m: self._turn(m, m[self.text]))

    def turns_of_parts(self, record: Column, bare: Column) -> Column:
        """As ``turns``, with a list of parts read as its texts; ``bare`` is the record without texts, where only a list starts with a bracket."""
        both = F.arrays_zip(self._items(record).alias("m"), self._items(bare).alias("b"))
        return F.transform(
            both,
            lambda x: self._turn(x["m"], F.when(F.startswith(x["b"][self.text], F.lit("[")), _joined_parts(x["m"][self.text], x["b"][self.text])).otherwise(x["m"][self.text])),
        )


@dataclass(frozen=True)
class Fields:
    """Top-level text fields; ``parts`` gives each turn's role and the fields joined in it."""

    parts: tuple[tuple[str, tuple[str, ...]], ...]
    optional: tuple[str, ...] = ()

    def structures(self) -> list[str]:
        names = [n for _, fields in self.parts for n in fields]
        fixed = [n for n in names if n not in self.optional]
        return [_object(dict.fromkeys((*fixed, *extra))) for extra in _subsets(self.optional)]

    def needs(self) -> list[list[str]]:
        return [[n for _, fields in self.parts for n in fields if n not in self.optional]]

    def turns_of_parts(self, record: Column, bare: Column) -> Column:
        return self.turns(record)

    def turns(self, record: Column) -> Column:
        out = []
        read = F.from_json(record, ", ".join(f"{n} string" for _, names in self.parts for n in names), ANY_LENGTH)
        for role, names in self.parts:
            got = [F.nullif(read[n], F.lit("")) for n in names]
            # A turn made of optional fields only is left out when all of them are absent or empty.
            text = F.concat_ws("\n\n", *got)
            turn = F.array(F.struct(F.lit(role).alias("role"), text.alias("text")))
            if all(n in self.optional for n in names):
                turn = F.when(text == "", F.array().cast(TURNS_TYPE)).otherwise(turn)
            out.append(turn)
        return F.concat(*out)


def _joined_parts(parts: Column, bare: Column) -> Column:
    """Texts of a JSON list of ``{"text": ...}`` objects or strings, a blank line between; parts without a text add nothing."""
    both = F.arrays_zip(F.from_json(parts, "array<string>", ANY_LENGTH).alias("p"), F.from_json(bare, "array<string>", ANY_LENGTH).alias("b"))
    return F.concat_ws(
        "\n\n",
        F.transform(both, lambda x: F.when(F.startswith(x["b"], F.lit("{")), F.from_json(x["p"], "text string", ANY_LENGTH)["text"]).when(x["b"] == "", x["p"])),
    )


def _subsets(names: tuple[str, ...]):
    return [c for k in range(len(names) + 1) for c in itertools.combinations(names, k)]


def _object(fields: dict[str, str | None]) -> str:
    """Structure text of an object; keys in code point order, as variants keep them."""
    return "OBJECT<" + ", ".join(k if v is None else f"{k}: {v}" for k, v in sorted(fields.items())) + ">"


def _renamed(role: Column, names: dict[str, str]) -> Column:
    out = F.coalesce(role, F.lit(""))
    for old, new in names.items():
        out = F.when(role == old, F.lit(new)).otherwise(out)
    return out


LAYOUTS = {
    "messages": MessageList("messages", "role", "content", ("name",)),
    "message_texts": MessageList("messages", "role", "text"),
    "conversations": MessageList("conversations", "from", "value", (), {"human": "user", "gpt": "assistant"}),
    "dialog": MessageList("dialog", "speaker", "utterance"),
    "instruction": Fields((("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))), ("system", "input")),
    "prompt_completion": Fields((("user", ("prompt",)), ("assistant", ("completion",)))),
    "prompt_response": Fields((("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), ("system",)),
    "question_answer": Fields((("user", ("context", "question")), ("assistant", ("answer",))), ("context",)),
}

#: Scalar types in the text of a variant's schema; arrays and objects are structure, and so may be what differs in type (VARIANT).
_SCALAR = r"(?:STRING|BIGINT|BOOLEAN|DOUBLE|FLOAT|VOID|DECIMAL\(\d+, ?\d+\)|TINYINT|SMALLINT|INT|BINARY|DATE|TIMESTAMP_NTZ|TIMESTAMP)"


#: Inside of a valid JSON string.
_INSIDE = r'[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+'
#: A field name with its text if it has one, or a text in a list; the groups are what is left without the text.
_TEXTS = rf'("{_INSIDE}"\s*+:\s*+)(?:("){_INSIDE}("))?+|("){_INSIDE}(")'
#: Equal objects in a row.
_REPEATED = r'(\{(?:"[^"\\]*+"|[^{}"])*+\})(?:\s*+,\s*+\1)++'
#: Records that are longer without their texts are read with repeated objects as one, and must not fail unnoticed.
LONG_RECORD = 2**20


def without_texts(record: Column, long_record: int = LONG_RECORD) -> Column:
    """A JSON record with empty texts, of the same field paths; text that is no JSON stays so."""
    bare = F.regexp_replace(record, _TEXTS, "$1$2$3$4$5")
    return F.when(F.length(bare) > long_record, F.regexp_replace(bare, _REPEATED, "$1")).otherwise(bare)


def structure_of(record: Column, long_record: int = LONG_RECORD) -> Column:
    """Nested field paths of a JSON record as text, without scalar types; null for text that is no JSON.

    The paths are read without the texts, since variants end at 128 MiB and
    their strings at 20,000,000 characters.  A record that is too large even so
    raises an error.
    """
    bare = without_texts(record, long_record)
    variant = F.try_parse_json(bare)
    too_large = variant.isNull() & (F.length(bare) > long_record) & F.json_object_keys(bare).isNotNull()
    schema = F.when(too_large, F.raise_error(F.lit("a JSON record is too large to read its field paths")).cast("string")).otherwise(F.schema_of_variant(variant))
    return F.regexp_replace(schema, rf": {_SCALAR}(?=[,>])", "")


def fingerprint_of(structure: Column) -> Column:
    return F.xxhash64(structure)


def canonical_turns(record: Column, fingerprint: Column, layouts: dict = LAYOUTS) -> tuple[Column, Column]:
    """``(layout name, turns)`` of a record by its fingerprint; both null when no layout has it."""
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS_TYPE)
    for key, layout in layouts.items():
        own = fingerprint.isin([_hash_literal(s) for s in layout.structures()])
        name = F.when(own, F.lit(key)).otherwise(name)
        turns = F.when(own, layout.turns(record)).otherwise(turns)
    return name, turns


def field_paths(bare: Column, lists: list[str]) -> Column:
    """Field paths of a record without texts: top-level names, and ``name[].field`` for the objects of the lists named.

    A field that holds a list is written ``field[]``, an object ``field{}``; an
    empty list is ``name[]`` alone.
    """

    def marked(entry: Column, prefix: str) -> Column:
        value = entry["value"]
        mark = F.when(F.startswith(value, F.lit("[")), "[]").when(F.startswith(value, F.lit("{")), "{}").otherwise("")
        return F.concat(F.lit(prefix), entry["key"], mark)

    def paths(top: Column) -> Column:
        out = [F.filter(F.transform(F.map_entries(top), lambda e: marked(e, "")), lambda p: ~p.isin([f"{n}[]" for n in lists]))]
        for n in lists:
            items = F.filter(F.from_json(top[n], "array<map<string,string>>", ANY_LENGTH), lambda m: m.isNotNull())
            inner = F.flatten(F.transform(items, lambda m: F.transform(F.map_entries(m), lambda e: marked(e, f"{n}[]."))))
            nothing = F.array().cast("array<string>")
            found = F.when(F.regexp_like(top[n], F.lit(r"^\[\s*\]$")), F.array(F.lit(f"{n}[]"))).when(F.startswith(top[n], F.lit("[")), inner).otherwise(nothing)
            out.append(F.coalesce(found, nothing))
        return F.array_distinct(F.concat(*out))

    return _let(F.from_json(bare, "map<string,string>", ANY_LENGTH), paths)


def turns_by_need(record: Column, bare: Column, paths: Column, layouts: dict = LAYOUTS) -> tuple[Column, Column]:
    """``(layout name, turns)`` of the first layout whose needed field paths are all among ``paths``, told by their hash."""
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS_TYPE)
    for key, layout in reversed(layouts.items()):
        known = sorted({p for need in layout.needs() for p in need})
        held = F.xxhash64(F.array_intersect(F.array(*[F.lit(p) for p in known]), paths))
        own = held.isin([F.xxhash64(F.array(*[F.lit(p) for p in known if p in need])) for need in layout.needs()])
        name = F.when(own, F.lit(key)).otherwise(name)
        turns = F.when(own, layout.turns_of_parts(record, bare)).otherwise(turns)
    return name, turns


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where it is used inside of functions on arrays."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _hash_literal(structure: str) -> Column:
    return F.xxhash64(F.lit(structure))


def layout_counts(formatted: DataFrame) -> DataFrame:
    """``fingerprint, layout, n`` of formatted records; records of a null layout have no output."""
    return formatted.groupBy("fingerprint", "layout").agg(F.count("*").alias("n"))


# --------------------------------------------------------------- template

@dataclass(frozen=True)
class Template:
    """Marks around a turn's text by role; other roles use ``other`` with the role written in the mark."""

    marks: tuple[tuple[str, str, str], ...] = (
        ("system", "[SYS] ", " [/SYS]"),
        ("user", "[INST] ", " [/INST]"),
        ("assistant", "[OUT] ", "</s>"),
    )
    other: tuple[str, str, str] = ("[TURN ", "] ", " [/TURN]")
    loss_roles: tuple[str, ...] = ("assistant",)


TEMPLATE = Template()
#: Strings that never stand inside an escaped text.
CONTROL = r"(<)(/?s>)|(\[)(/?(?:SYS|INST|OUT|TURN))"
_TURN = r"(?s)\[(?:SYS|INST|OUT|TURN [^\]]*)\] .*?(?: \[/SYS\]| \[/INST\]|</s>| \[/TURN\])"


def escape(text: Column) -> Column:
    r"""``\`` doubled, and a ``\`` put behind the first character of every control string."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1$3\\$2$4")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escape_role(role: Column) -> Column:
    for char, code in (("%", "%25"), ("[", "%5B"), ("]", "%5D"), ("<", "%3C"), ("\\", "%5C")):
        role = F.replace(role, F.lit(char), F.lit(code))
    return role


def _unescape_role(role: Column) -> Column:
    for char, code in (("\\", "%5C"), ("<", "%3C"), ("]", "%5D"), ("[", "%5B"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(char))
    return role


def _rendered(turn: Column, template: Template) -> Column:
    """``struct<open, body, close, loss>`` of a turn."""
    opening = F.concat(F.lit(template.other[0]), _escape_role(turn["role"]), F.lit(template.other[1]))
    closing = F.lit(template.other[2])
    for role, before, after in template.marks:
        opening = F.when(turn["role"] == role, F.lit(before)).otherwise(opening)
        closing = F.when(turn["role"] == role, F.lit(after)).otherwise(closing)
    return F.struct(
        opening.alias("open"),
        escape(turn["text"]).alias("body"),
        closing.alias("close"),
        turn["role"].isin(list(template.loss_roles)).alias("loss"),
    )


def format_records(
    df: DataFrame, record_column: str, keep: list[str], layouts: dict = LAYOUTS, template: Template = TEMPLATE
) -> DataFrame:
    """Add ``fingerprint, layout, formatted, loss_spans`` to the columns of ``keep``.

    ``loss_spans`` are ``struct<start, len>`` (code points, start from 1) of the
    escaped texts under the loss mask.  A null record, text that is no JSON
    object, and a record that holds no layout's needed fields give null layout,
    output and spans (``layout_counts`` tells how many); an empty list of
    messages gives the empty output.  Fields that a layout does not know are
    ignored; of several layouts that fit a record the first one is taken.  A
    message's text may be a list of parts, whose texts are joined by a blank line.
    """
    rec = df.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col(f"`{record_column}`").alias("__rec"),
        fingerprint_of(structure_of(F.col(f"`{record_column}`"))).alias("fingerprint"),
        structure_of(F.col(f"`{record_column}`")).isNotNull().alias("__ok"),
    )
    name, turns = canonical_turns(F.col("__rec"), F.col("fingerprint"), layouts)
    made = rec.withColumns({"layout": F.when(F.col("__ok"), name), "__turns": F.when(F.col("__ok"), turns)})
    # The fields of records whose fingerprint is no layout's own.
    lists = sorted({x.field for x in layouts.values() if isinstance(x, MessageList)})
    other = F.col("__ok") & F.col("layout").isNull()
    made = made.withColumn("__bare", F.when(other, F.regexp_replace("__rec", _TEXTS, "$1$2$3$4$5")))
    made = made.withColumn("__paths", F.when(other, field_paths(F.col("__bare"), lists)))
    name, turns = turns_by_need(F.col("__rec"), F.col("__bare"), F.col("__paths"), layouts)
    known = F.col("__paths").isNull()
    made = made.withColumns({"layout": F.when(known, F.col("layout")).otherwise(name), "__turns": F.when(known, F.col("__turns")).otherwise(turns)})
    made = made.withColumn("__parts", F.transform("__turns", lambda t: _rendered(t, template)))
    made = made.withColumn("formatted", F.array_join(F.transform("__parts", lambda p: F.concat(p["open"], p["body"], p["close"])), ""))
    made = made.withColumn("loss_spans", _loss_spans(F.col("__parts")))
    return made.select(*[F.col(f"`{c}`") for c in keep], "fingerprint", "layout", "formatted", "loss_spans")


#: Turns whose spans are gathered in one array before they join the others.
SPAN_BLOCK = 256
_SPANS = "array<struct<start:bigint,len:bigint>>"


def _loss_spans(parts: Column) -> Column:
    """Spans under the loss mask: running offsets within blocks of turns, then of the blocks, so that long lists are not copied per turn."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        before, body = acc["at"] + F.length(p["open"]), F.length(p["body"]).cast("long")
        span = F.struct((before + 1).alias("start"), body.alias("len"))
        return F.struct(
            (before + body + F.length(p["close"])).alias("at"),
            F.when(p["loss"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_SPANS}>").alias("spans"))

    def join(acc: Column, block: Column) -> Column:
        moved = F.transform(block["spans"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), s["len"].alias("len")))
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["spans"], F.array(moved)).alias("spans"))

    numbers = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / SPAN_BLOCK).cast("int"))
    blocks = F.transform(numbers, lambda i: F.aggregate(F.slice(parts, i * SPAN_BLOCK + 1, SPAN_BLOCK), zero, step))
    spans = F.flatten(F.aggregate(blocks, first, join, lambda acc: acc["spans"]))
    return F.when(F.size(parts) > 0, spans).when(parts.isNotNull(), F.array().cast(_SPANS))


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """Turns read back from formatted text: the inverse of the template."""
    head, tail = template.other[0], template.other[2]

    def one(found: Column) -> Column:
        role = _unescape_role(F.regexp_extract(found, r"^\[TURN ([^\]]*)\] ", 1))
        body = F.regexp_extract(found, r"(?s)^\[[^\]]*\] (.*)$", 1)
        size = F.lit(len(tail))
        for name, before, after in template.marks:
            own = F.startswith(found, F.lit(before)) & ~F.startswith(found, F.lit(head))
            role = F.when(own, F.lit(name)).otherwise(role)
            size = F.when(own, F.lit(len(after))).otherwise(size)
        return F.struct(role.alias("role"), unescape(F.substring(body, F.lit(1), F.length(body) - size)).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), one)


#: Characters of a piece in which spans are looked up; a string's characters can only be counted from its start.
PIECE = 4096


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""

    def one(pieces: Column, s: Column) -> Column:
        first = F.floor((s["start"] - 1) / PIECE).cast("int")
        last = F.greatest(first, F.floor((s["start"] + s["len"] - 2) / PIECE).cast("int"))
        near = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
        return unescape(F.substring(near, (s["start"] - first * F.lit(PIECE)).cast("int"), s["len"].cast("int")))

    pieces = F.regexp_extract_all(formatted, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))
    return _let(pieces, lambda p: F.array_join(F.transform(spans, lambda s: one(p, s)), ""))


# --------------------------------------------------------------- conversations table

def conversation_records(rows: DataFrame) -> DataFrame:
    """``conv_id, record``: one messages record per conversation of a table ``conv_id, turn, role, text``.

    Rows are ordered by turn, then role, then text; null turns come first and
    null roles and texts count as empty.  Null ``conv_id`` rows form one
    conversation of their own.
    """
    src = rows.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long").alias("turn"),
        F.struct(F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("content")).alias("m"),
    )
    return src.groupBy("conv_id").agg(
        F.to_json(F.struct(F.transform(F.sort_array(F.collect_list(F.struct("turn", "m"))), lambda x: x["m"]).alias("messages"))).alias("record")
    )


def conversation_digests(rows: DataFrame) -> DataFrame:
    """The digest columns of the formatted conversations, all read back from the output."""
    out = format_records(conversation_records(rows), "record", ["conv_id"])
    turns, loss = read_turns(F.col("formatted")), loss_text(F.col("formatted"), F.col("loss_spans"))
    out = out.withColumns({"__turns": turns, "__loss": loss})
    flat = F.array_join(F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("__turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length("__loss").cast("long").alias("loss_chars"),
        F.sha2("__loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: DuckDB has no need of the template's text: its length follows from marks and escapes.
SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *,
        length(text) + length(text) - length(replace(text, '\', ''))
          + len(regexp_extract_all(text, '</?s>|\[/?(?:SYS|INST|OUT|TURN)')) AS body,
        CASE role WHEN 'system' THEN length('[SYS]  [/SYS]') WHEN 'user' THEN length('[INST]  [/INST]')
             WHEN 'assistant' THEN length('[OUT] </s>')
             ELSE length('[TURN ]  [/TURN]') + length(role) + 2 * len(regexp_extract_all(role, '[\[\]%<\\]')) END AS marks
    FROM rows
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(body + marks) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
