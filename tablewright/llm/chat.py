"""Chat formatting by schema fingerprints (operator 4). DataFrame and SQL functions only.

A record is JSON of any known layout. The hash of its nested field paths picks a declarative mapping, which says where the
turns stand; a layout is added by adding a mapping. Turns are then written between marks. Inside texts and roles a
backslash is doubled and the head of every control string ``<|`` is broken up, so that no text can close its own turn, and
reading the output back gives the texts again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Mapping:
    """A layout: its field paths, and its turns as (role, path of the text), or ``list_path`` of an array of turns."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    list_path: str | None = None
    role_field: str = "role"
    text_field: str = "content"


MAPPINGS = (
    Mapping("messages", ("messages[].content", "messages[].role"), list_path="messages"),
    Mapping("messages_empty", ("messages[]",), list_path="messages"),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), list_path="conversations", role_field="from", text_field="value"),
    Mapping("prompt", ("prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt_system", ("prompt", "response", "system"), (("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("instruction", ("instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction_input", ("input", "instruction", "output"), (("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("instruction_system", ("instruction", "output", "system"), (("system", "system"), ("user", "instruction"), ("assistant", "output"))),
)


def field_shape(record: Column) -> Column:
    """The nested field names of a JSON text, without the kinds of its values; NULL if it is not JSON."""
    kinds = r"(?<=[:<] ?)(?:VOID|STRING|BOOLEAN|BIGINT|DOUBLE|FLOAT|DECIMAL\([0-9, ]+\)|VARIANT|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|UUID)(?=[,>]|$)"
    return F.regexp_replace(F.schema_of_variant(F.try_parse_json(record)), kinds, "")


def _shape(paths: Sequence[str]) -> str:
    """What ``field_shape`` gives for a record with these paths."""
    nested: dict[str, list[str]] = {}
    for path in paths:
        head, _, tail = path.partition("[]")
        nested.setdefault(head, [])
        if path != head:
            nested[head].append(tail.removeprefix("."))
    parts = []
    for head in sorted(nested):
        inner = sorted(t for t in nested[head] if t)
        if inner:
            parts.append(f"{head}: ARRAY<OBJECT<{', '.join(f'{t}: ' for t in inner)}>>")
        else:
            parts.append(f"{head}: ARRAY<>" if nested[head] else f"{head}: ")
    return f"OBJECT<{', '.join(parts)}>"


def fingerprint(record: Column) -> Column:
    """64-bit hash of a record's nested field paths."""
    return F.xxhash64(field_shape(record))


def _turn_of(m: Mapping) -> Callable[[Column], Column]:
    def turn(t: Column) -> Column:
        role, text = (F.coalesce(t[field], F.lit("")) for field in (m.role_field, m.text_field))
        return F.struct(role.alias("role"), text.alias("text"))

    return turn


def canonical_turns(record: Column, mappings: Sequence[Mapping] = MAPPINGS) -> tuple[Column, Column]:
    """Layout name and turns (role, text) of a JSON record; both NULL if no mapping has its fingerprint. NULLs become empty."""
    fields: dict[str, str] = {}
    for m in mappings:
        if m.list_path:
            fields[m.list_path] = f"ARRAY<STRUCT<`{m.role_field}`: STRING, `{m.text_field}`: STRING>>"
        for _, path in m.turns:
            fields[path] = "STRING"
    parsed = F.from_json(record, ", ".join(f"`{k}` {v}" for k, v in fields.items()))
    mark, layout, turns = fingerprint(record), F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for m in mappings:
        if m.list_path:
            found = F.transform(parsed[m.list_path], _turn_of(m))
        else:
            found = F.array(
                *[F.struct(F.lit(r).alias("role"), F.coalesce(parsed[p], F.lit("")).alias("text")) for r, p in m.turns]
            )
        here = mark == F.xxhash64(F.lit(_shape(m.paths)))
        layout, turns = F.when(here, F.lit(m.name)).otherwise(layout), F.when(here, found).otherwise(turns)
    return layout, turns


def escape(text: Column) -> Column:
    """Reversible, and free of ``<|`` and of line feeds written as such in roles; see ``unescape``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    parts = F.split(text, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|"))), "\\")


def format_chats(records: DataFrame, record: str = "record", mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """Records with ``layout``, ``formatted``, and per turn ``turn_chars`` (its code points in the formatted text) and ``turn_loss``.

    Only texts of assistant turns bear loss. A record that is NULL, not JSON or of an unknown layout keeps its row with NULL in the new
    columns. A NULL or missing text is empty, a record without turns gives an empty text. Repeated rows stay. The columns, and two that are used
    inside, must be new; all others pass through.
    """
    if used := {"layout", "formatted", "turn_chars", "turn_loss", "_turns", "_parts"} & set(records.columns):
        raise ValueError(f"columns {sorted(used)} exist already")
    layout, turns = canonical_turns(F.col(record), mappings)

    def one(t: Column) -> Column:
        role = F.replace(escape(t["role"]), F.lit("\n"), F.lit("\\n"))
        return F.concat(F.lit(OPEN), role, F.lit("\n"), escape(t["text"]), F.lit(CLOSE + "\n"))

    out = records.withColumn("layout", layout).withColumn("_turns", turns).withColumn("_parts", F.transform("_turns", one))
    return out.select(
        *records.columns,
        "layout",
        F.array_join("_parts", "").alias("formatted"),
        F.transform("_parts", F.length).alias("turn_chars"),
        F.transform("_turns", lambda t: t["role"] == "assistant").alias("turn_loss"),
    )


def read_turns(formatted: Column, turn_loss: Column) -> Column:
    """Turns (role, text, loss) of a formatted text, unescaped."""
    pieces = F.split(formatted, r"<\|im_start\|>", -1)
    pieces = F.slice(pieces, F.lit(2), F.size(pieces))

    def turn(piece: Column, i: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        # behind the role: a line feed, the text, the closing mark and a line feed
        text = F.substr(piece, F.length(role) + 2, F.length(piece) - F.length(role) - len(CLOSE) - 2)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"), F.element_at(turn_loss, i + 1).alias("loss"))

    return F.transform(pieces, turn)
