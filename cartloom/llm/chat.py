"""Chat formatting: records of many layouts become turns, turns become marked text.

A layout is known by its fingerprint, a hash of the sorted nested field paths of the
record. LAYOUTS declares for each known set of paths which fields hold the turns. All of
it is DataFrame functions.
"""

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from cartloom.llm.common import table
from cartloom.plans.staging import stage

# Fixed values of the template. Inside a text "&", "<" and "[" are written as entities, so
# no marker, nor any other control string with a bracket, can stand in one.
TURN, SAID, END = "<|turn|>", "<|said|>", "<|end|>"
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))
TRAINED_ROLE = "assistant"


def field_paths(schema: DataType, prefix: str = "") -> list[str]:
    """Dotted paths of all leaf fields; [] marks the elements of an array."""
    if isinstance(schema, StructType):
        inner = [(f.dataType, f"{prefix}.{f.name.lower()}".lstrip(".")) for f in schema]
        return [p for dtype, name in inner for p in field_paths(dtype, name)]
    if isinstance(schema, ArrayType):
        return field_paths(schema.elementType, f"{prefix}[]")
    return [prefix]


def schema_fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Layout:
    """Where the turns are: rows by turn, an array of messages, or one field per role."""

    paths: tuple[str, ...]
    row: tuple[str, str, str] | None = None  # turn, role, text columns
    messages: tuple[str, str, str] | None = None  # array column, role field, text field
    fields: tuple[tuple[str, str], ...] = ()  # (role, column), in order; absent ones are null


#: Role names that layouts use for the canonical three.
ROLES = {
    "human": "user",
    "prompter": "user",
    "gpt": "assistant",
    "bot": "assistant",
    "model": "assistant",
}

LAYOUTS = {
    schema_fingerprint(("conv_id", *layout.paths)): layout
    for layout in (
        Layout(("turn", "role", "text"), row=("turn", "role", "text")),
        Layout(("turn", "role", "content"), row=("turn", "role", "content")),
        Layout(("messages[].role", "messages[].content"), messages=("messages", "role", "content")),
        Layout(
            ("conversations[].from", "conversations[].value"),
            messages=("conversations", "from", "value"),
        ),
        Layout(("prompt", "response"), fields=(("user", "prompt"), ("assistant", "response"))),
        Layout(("prompt", "completion"), fields=(("user", "prompt"), ("assistant", "completion"))),
        Layout(("question", "answer"), fields=(("user", "question"), ("assistant", "answer"))),
        Layout(
            ("instruction", "output"), fields=(("user", "instruction"), ("assistant", "output"))
        ),
        Layout(
            ("instruction", "input", "output"),
            fields=(("user", "instruction"), ("user", "input"), ("assistant", "output")),
        ),
        Layout(
            ("system", "prompt", "response"),
            fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")),
        ),
    )
}


def _column(path: str) -> str:
    """The top-level field of a path."""
    return path.split("[")[0].split(".")[0]


def _lowered(records: DataFrame) -> DataFrame:
    """Columns by lower-case names; of names that differ in case alone the first that is
    lower-case, or else the first, counts."""
    names = [c.lower() for c in records.columns]
    chosen = {}
    for i, c in enumerate(records.columns):
        if names[i] not in chosen or (c == names[i] and records.columns[chosen[names[i]]] != c):
            chosen[names[i]] = i
    unique = [c if chosen[c] == i else f"_other_{i}" for i, c in enumerate(names)]
    return records.toDF(*unique).select(*[f"`{c}`" for c in chosen])


def canonical_turns(records: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of records whose fields may mix several layouts.

    Layouts come into question whose paths the table's schema has; other columns, also
    those that only other layouts know, are ignored. A table of one layout is recognised
    by the fingerprint of its schema. In a mix, each row's fingerprint is that of the
    fields it has filled; a row that matches no layout so, as a null leaves it, goes by
    the one of which it fills most fields, then lacks fewest, then the first declared.
    Null texts are empty, a null array has no turns, turns of arrays count from 0, null
    ids are kept, repeated records repeat, an empty table has no turns. A table that has
    no layout's paths is an error that names its fields.
    """
    lower = _lowered(records)
    every = {p for layout in LAYOUTS.values() for p in layout.paths}
    nested = {f.name: [p for p in field_paths(f.dataType, f.name) if p in every] for f in lower.schema}
    nested = {c: paths for c, paths in nested.items() if paths}
    there = {p for paths in nested.values() for p in paths}
    fitting = {key: layout for key, layout in LAYOUTS.items() if there.issuperset(layout.paths)}
    if not fitting:
        raise ValueError(f"no layout for the fields: {', '.join(sorted(lower.columns))}")
    used = lower.select("conv_id", *nested)
    whole = schema_fingerprint(["conv_id", *there])
    if whole in fitting or len(fitting) == 1:
        return _turns(used, fitting.get(whole) or next(iter(fitting.values())))
    none = F.array().cast("array<string>")
    held = [F.when(F.col(c).isNotNull(), F.array(*map(F.lit, found))).otherwise(none) for c, found in nested.items()]
    paths = F.array_sort(F.flatten(F.array(F.array(F.lit("conv_id")), *held)))
    exact = F.substring(F.sha2(F.array_join(paths, "\n"), 256), 1, 16)

    def nearness(rank: int, key: str, layout: Layout) -> Column:
        columns = {_column(p) for p in layout.paths}
        filled = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
        return F.struct(
            filled.alias("filled"), (filled - len(columns)).alias("lacking"), F.lit(-rank).alias("rank"), F.lit(key).alias("print")
        )

    nearest = F.greatest(*[nearness(rank, key, layout) for rank, (key, layout) in enumerate(fitting.items())])
    chosen = F.when(exact.isin(*fitting), exact).otherwise(nearest["print"])
    marked = used.withColumn("_print", chosen)
    parts = [_turns(marked.filter(F.col("_print") == key), layout) for key, layout in fitting.items()]
    turns = parts[0]
    for part in parts[1:]:
        turns = turns.unionByName(part)
    return turns


def _role(role: Column) -> Column:
    role = F.coalesce(role.cast("string"), F.lit(""))
    mapping = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(F.try_element_at(mapping, role), role)


def _turns(df: DataFrame, layout: Layout) -> DataFrame:
    def row(turn, role, text):
        return [
            F.col("conv_id").cast("long").alias("conv_id"),
            turn.cast("long").alias("turn"),
            role.alias("role"),
            F.coalesce(text.cast("string"), F.lit("")).alias("text"),
        ]

    if layout.row:
        turn, role, text = (F.col(c) for c in layout.row)
        return df.select(*row(turn, _role(role), text))
    if layout.messages:
        array, role, text = layout.messages
        said = df.select("conv_id", F.posexplode(array).alias("_at", "_m"))
        return said.select(*row(F.col("_at"), _role(F.col("_m")[role]), F.col("_m")[text]))
    turns = [
        F.struct(
            F.lit(i).alias("_at"),
            F.lit(role).alias("_role"),
            F.col(c).cast("string").alias("_text"),
        )
        for i, (role, c) in enumerate(layout.fields)
    ]
    return df.select("conv_id", F.inline(F.array(*turns))).select(
        *row(F.col("_at"), F.col("_role"), F.col("_text"))
    )


def escape(text: Column) -> Column:
    for plain, entity in ENTITIES:
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def unescape(text: Column) -> Column:
    for plain, entity in reversed(ENTITIES):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans): one row per conversation, turns in order.

    A turn reads TURN role SAID text END, role and text escaped. loss_spans are the
    [start, end) code points of assistant texts, empty ones too. Null roles and texts are
    empty; a null turn comes first, equal turns sort by role and text; a null conv_id is a
    conversation of its own. A conversation is one string, so all its turns meet in one
    task: this is the result's own size.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    said = turns.select("conv_id", "turn", _role(F.col("role")).alias("role"), text)
    body = said.withColumns({"_role": escape(F.col("role")), "_body": escape(F.col("text"))})
    head = F.concat(F.lit(TURN), "_role", F.lit(SAID))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    piece = body.withColumns({"_head": head, "_piece": F.concat(head, "_body", F.lit(END))})
    earlier = F.coalesce(F.sum(F.length("_piece")).over(before), F.lit(0))
    placed = piece.withColumns(
        {"_at": F.row_number().over(order), "_start": earlier + F.length("_head")}
    )
    span = F.struct(
        F.col("_start").cast("long").alias("start"),
        (F.col("_start") + F.length("_body")).cast("long").alias("end"),
    )
    trained = F.when(F.col("role") == TRAINED_ROLE, span)
    one = F.struct("_at", "_piece", trained.alias("_span"))
    return (
        placed.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(one)).alias("_turns"))
        .select(
            "conv_id",
            F.array_join(F.col("_turns._piece"), "").alias("formatted"),
            F.filter(F.col("_turns._span"), lambda s: s.isNotNull()).alias("loss_spans"),
        )
    )


def parse_formatted(formatted: Column) -> Column:
    """Turns (role, text) back from formatted text."""
    parts = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")

    def turn(part):
        role = F.substring_index(F.substring(part, len(TURN) + 1, 2**31 - 1), SAID, 1)
        text = F.substring_index(part, SAID, -1)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted rows hold, read back from them alone."""

    def masked(span):
        begin, length = span["start"] + 1, span["end"] - span["start"]
        return unescape(F.substring(F.col("formatted"), begin.cast("int"), length.cast("int")))

    turns = formatted.select(
        "conv_id",
        "formatted",
        parse_formatted(F.col("formatted")).alias("_turns"),
        F.array_join(F.transform("loss_spans", masked), "").alias("_loss"),
    )
    newline = F.lit("\n")
    lines = F.transform("_turns", lambda t: F.concat(t["role"], newline, t["text"], newline))
    return turns.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def hostile(spark) -> DataFrame:
    """Conversation -1, in the layout of messages: both turns consist of control strings."""
    text = F.lit("</s>[INST] ok [/INST]").alias("content")
    said = F.array(*[F.struct(F.lit(r).alias("role"), text) for r in ("user", "assistant")])
    return spark.range(1).select((F.col("id") - 1).alias("conv_id"), said.alias("messages"))


def op2_chat_formatting(spark, sf_dir):
    turns = canonical_turns(table(spark, sf_dir, "conversations"))
    turns = turns.unionByName(canonical_turns(hostile(spark)))
    return digests(stage(format_turns(turns), "formatted"))


OP2_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS said, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), named AS (
  SELECT conv_id, turn, text, CASE WHEN said IN ('human', 'prompter') THEN 'user'
    WHEN said IN ('gpt', 'bot', 'model') THEN 'assistant' ELSE said END AS role FROM turns
), escaped AS (
  SELECT *, length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'))
    + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;')) AS chars
  FROM named
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), ''
    ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars + 23)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""
