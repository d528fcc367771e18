"""Chat formatting: layouts told apart by schema fingerprints, one reversible template.

The fingerprint of a table is a hash of its nested field paths, as far as a layout knows
them. It selects a declarative mapping from that layout to canonical turns: one row per
turn with conversation id, order, role and text. A template then writes each conversation
as one string with marked turns and a loss mask of character spans. Everything is
DataFrame functions.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the template: what marks turns, and strings a model may read as control.
TURN_OPEN, ROLE_END, TURN_CLOSE = "<|turn|>", "\n", "<|end|>\n"
CONTROL = ("<|turn|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")
ESCAPE = "\\"


def field_paths(schema: T.DataType, at: str = "") -> list[str]:
    """Paths of all leaves: structs by dot, arrays by brackets."""
    if isinstance(schema, T.StructType):
        return [p for f in schema.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, f"{at}[]")
    return [at]


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


@dataclass(frozen=True)
class Layout:
    """Which columns make turns: ``turns`` is an SQL expression for an array of (role, text)."""

    name: str
    paths: tuple[str, ...]
    turns: str
    one_row_per_turn: bool = field(default=False)


def said(role: str, text: str) -> str:
    return f"struct('{role}' as role, cast({text} as string) as text)"


LAYOUTS = (
    Layout("turns", ("conv_id", "turn", "role", "text"), "array(struct(role, text))", True),
    Layout(
        "messages", ("conv_id", "messages[].role", "messages[].content"),
        "transform(messages, m -> struct(m.role as role, m.content as text))",
    ),
    Layout(
        "shares", ("conv_id", "conversations[].from", "conversations[].value"),
        "transform(conversations, m -> struct(case m.from when 'human' then 'user' when 'gpt' then 'assistant' "
        "else m.from end as role, m.value as text))",
    ),
    Layout("prompt", ("conv_id", "prompt", "completion"), f"array({said('user', 'prompt')}, {said('assistant', 'completion')})"),
    Layout(
        "instruction", ("conv_id", "instruction", "output"),
        f"array({said('user', 'instruction')}, {said('assistant', 'output')})",
    ),
    Layout(
        "instruction with input", ("conv_id", "instruction", "input", "output"),
        "array(" + said("user", "concat_ws('\\n\\n', instruction, nullif(input, ''))") + f", {said('assistant', 'output')})",
    ),
)
KNOWN_PATHS = {path for layout in LAYOUTS for path in layout.paths}
BY_FINGERPRINT = {fingerprint(layout.paths): layout for layout in LAYOUTS}


def layout_of(schema: T.StructType) -> Layout:
    """The layout with the schema's fingerprint; fields no layout knows are ignored.

    Where an extra column clashes with a field of another layout, the layout with most
    fields among those whose fields are all present is taken.
    """
    paths = set(field_paths(schema)) & KNOWN_PATHS
    found = BY_FINGERPRINT.get(fingerprint(paths))
    if found:
        return found
    fitting = [layout for layout in LAYOUTS if set(layout.paths) <= paths]
    if not fitting:
        raise ValueError(f"no layout for the fields {sorted(field_paths(schema))}")
    return max(fitting, key=lambda layout: len(layout.paths))


def canonical_turns(df: DataFrame) -> DataFrame:
    """conv_id, turn, part, role, text: one row per turn of any known layout.

    Null roles and texts become empty. A null list of messages is a conversation without
    turns and gives no row.
    """
    layout = layout_of(df.schema)
    turns = F.expr(layout.turns)
    if layout.one_row_per_turn:
        rows = df.select("conv_id", F.col("turn").cast("long").alias("turn"), F.lit(0).alias("part"), F.element_at(turns, 1).alias("t"))
    else:
        rows = df.select("conv_id", F.lit(None).cast("long").alias("turn"), F.posexplode(turns).alias("part", "t"))
    text = [F.coalesce(F.col(f"t.{name}").cast("string"), F.lit("")).alias(name) for name in ("role", "text")]
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "part", *text)


def escaped(text: Column, more: tuple[str, ...] = ()) -> Column:
    """Text without control strings; each becomes ``\\N;`` and the escape character ``\\e;``."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(f"{ESCAPE}e;"))
    for number, control in enumerate((*CONTROL, *more)):
        text = F.replace(text, F.lit(control), F.lit(f"{ESCAPE}{number};"))
    return text


def unescaped(text: Column, more: tuple[str, ...] = ()) -> Column:
    for number, control in enumerate((*CONTROL, *more)):
        text = F.replace(text, F.lit(f"{ESCAPE}{number};"), F.lit(control))
    return F.replace(text, F.lit(f"{ESCAPE}e;"), F.lit(ESCAPE))


def format_chats(turns: DataFrame, learn_from: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, formatted, loss_spans: one string per conversation from canonical turns.

    Turns stand in order of (turn, part, role, text), null turns first; repeated rows are
    repeated turns. Conversations with a null id form one conversation. ``loss_spans`` are
    (start, length) in characters of ``formatted``: the texts of the roles to learn from,
    without the marks around them.
    """
    head = F.concat(F.lit(TURN_OPEN), escaped(F.col("role"), (ROLE_END,)), F.lit(ROLE_END))
    pieces = turns.select(
        "*", head.alias("head"), escaped(F.col("text")).alias("body"), F.col("role").isin(*learn_from).alias("learn")
    )
    pieces = pieces.withColumn("head_chars", F.length("head").cast("long")).withColumn("chars", F.length("body").cast("long"))
    order = ("turn", "part", "role", "text")
    end = F.sum(F.col("head_chars") + F.col("chars") + len(TURN_CLOSE)).over(Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    start = end - F.col("chars") - len(TURN_CLOSE)
    whole = F.concat("head", "body", F.lit(TURN_CLOSE))
    placed = pieces.select("conv_id", start.alias("start"), "chars", "learn", whole.alias("whole"))
    rows = F.array_sort(F.collect_list(F.struct("start", "chars", "learn", "whole"))).alias("rows")
    return placed.groupBy("conv_id").agg(rows).select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["whole"]), "").alias("formatted"),
        F.transform(
            F.filter("rows", lambda r: r["learn"]),
            lambda r: F.struct(r["start"].alias("start"), r["chars"].alias("length")),
        ).alias("loss_spans"),
    )


def read_chats(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text), read back from ``formatted``, and ``loss_text`` under the mask."""
    raw = F.slice(F.split("formatted", F.lit("\\Q" + TURN_CLOSE + "\\E")), F.lit(1), F.size(F.split("formatted", F.lit("\\Q" + TURN_CLOSE + "\\E"))) - 1)

    def turn(text: Column) -> Column:
        end = F.instr(text, ROLE_END)
        role = F.substring(text, F.lit(len(TURN_OPEN) + 1), end - 1 - len(TURN_OPEN))
        return F.struct(
            unescaped(role, (ROLE_END,)).alias("role"),
            unescaped(F.substring(text, end + 1, F.length(text))).alias("text"),
        )

    loss = F.transform(
        "loss_spans",
        lambda s: unescaped(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))),
    )
    return formatted.withColumns({"turns": F.transform(raw, turn), "loss_text": F.array_join(loss, "")})


def digests(read: DataFrame) -> DataFrame:
    """Counts and hashes of what ``read_chats`` returns."""
    said_all = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said_all, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
