"""Chat formatting: records of any known layout become canonical turns, and turns one marked text."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# The marks of the template. Texts that hold one get a backslash before it.
HEAD = "### "
HEAD_END = ": "
TURN_END = "\n</turn>\n"
CONTROL = r"(?:###|</turn>)"
LEARNED_ROLE = "assistant"


@dataclass(frozen=True)
class Layout:
    """How records with exactly these field paths become turns.

    ``turns`` names (role, paths) pairs, each one turn whose text joins the fields by an empty line;
    ``items`` names (list, role field, text field) for layouts that hold a list of messages.
    """

    name: str
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    items: tuple[str, str, str] | None = None

    @property
    def paths(self) -> frozenset[str]:
        if self.items:
            whole, role, text = self.items
            found = {f"{whole}[].{role}", f"{whole}[].{text}"}
        else:
            found = set()
        return frozenset(found | {p for _, fields in self.turns for p in fields})


# The layouts that are known, and role names with another spelling.
LAYOUTS = (
    Layout("messages", items=("messages", "role", "content")),
    Layout("system_messages", turns=(("system", ("system",)),), items=("messages", "role", "content")),
    Layout("conversations", items=("conversations", "from", "value")),
    Layout("system_conversations", turns=(("system", ("system",)),), items=("conversations", "from", "value")),
    Layout("instruction", turns=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("instruction_input", turns=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("prompt_completion", turns=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt_response", turns=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("system_prompt_response",
           turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question_answer", turns=(("user", ("question",)), ("assistant", ("answer",)))),
    Layout("nested_prompt", turns=(("user", ("data.prompt",)), ("assistant", ("data.response",)))),
)
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
# A layout of tables with one row per turn: its roles stay as they are.
ROW_PATHS = frozenset({"conv_id", "turn", "role", "text"})


def fingerprint(paths) -> str:
    """MD5 of the sorted field paths, one a line."""
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


def schema_paths(schema: T.StructType, prefix: str = "") -> set[str]:
    """Paths of all leaf fields: ``a.b`` in structs, ``a[].b`` in lists of structs."""
    found = set()
    for field in schema:
        kind, path = field.dataType, prefix + field.name
        if isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, path + "[]"
        found |= schema_paths(kind, path + ".") if isinstance(kind, T.StructType) else {path}
    return found


def _json_path(path: str) -> str:
    return "$." + path.replace("[]", "[0]")


def record_turns(records: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """Canonical turns (conv_id, turn, role, text) of JSON records of mixed layouts.

    ``records`` has ``conv_id`` and ``record``, a JSON text. The field paths that any layout names and
    the record holds are hashed, and the hash selects the layout. Fields that no layout names do not
    matter. Records of an unknown layout, and texts that are not JSON, give one turn with role and
    text null, so none is lost unseen. Field values that are JSON null count as absent.
    """
    value = F.col("_value")
    known = sorted({p for layout in layouts for p in layout.paths})
    present = F.array(*[
        F.when(F.try_variant_get(value, _json_path(p), "variant").isNotNull()
               & ~F.coalesce(F.is_variant_null(F.try_variant_get(value, _json_path(p), "variant")), F.lit(False)),
               F.lit(p))
        for p in known
    ])

    def text_of(path: str) -> Column:
        return F.try_variant_get(value, _json_path(path), "string")

    turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    for layout in layouts:
        parts = [
            F.array(F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *map(text_of, fields)).alias("text")))
            for role, fields in layout.turns
        ]
        if layout.items:
            whole, role, text = layout.items
            items = F.try_variant_get(value, f"$.{whole}", f"array<struct<`{role}`:string,`{text}`:string>>")
            parts.append(_renamed(items, role, text))
        turns = F.when(F.col("_print") == fingerprint(layout.paths), F.concat(*parts)).otherwise(turns)
    return (
        records.select("conv_id", F.try_parse_json("record").alias("_value"))
        .withColumn("_print", F.md5(F.array_join(F.array_sort(F.array_compact(present)), "\n")))
        .select("conv_id", F.posexplode_outer(turns).alias("turn", "_turn"))
        .select("conv_id", F.coalesce(F.col("turn"), F.lit(0)).cast("bigint").alias("turn"),
                F.col("_turn.role").alias("role"), F.col("_turn.text").alias("text"))
    )


def _renamed(items: Column, role: str, text: str) -> Column:
    return F.transform(items, lambda m: F.struct(_role_name(m[role]).alias("role"), m[text].alias("text")))


def _role_name(role: Column) -> Column:
    named = role
    for other, name in ROLE_NAMES.items():
        named = F.when(role == other, F.lit(name)).otherwise(named)
    return named


def canonical_turns(frame: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """Turns of a frame, by the fingerprint of its schema.

    A table with one row per turn passes on as it is; a frame with typed prompt, instruction or message
    columns, in which the layout may differ from row to row, goes through its JSON form.
    """
    known = ROW_PATHS | {p for layout in layouts for p in layout.paths}
    found = fingerprint(schema_paths(frame.schema) & known)
    if found == fingerprint(ROW_PATHS):
        return frame.select("conv_id", F.col("turn").cast("bigint"), "role", "text")
    if set(frame.columns) >= {"conv_id", "record"}:
        return record_turns(frame, layouts)
    fields = [F.col(f"`{c}`") for c in frame.columns if c != "conv_id"]
    return record_turns(frame.select("conv_id", F.to_json(F.struct(*fields)).alias("record")), layouts)


def escape(text: Column) -> Column:
    """One more backslash before each control string, whatever backslashes stand there already."""
    return F.regexp_replace(text, rf"(?<!\\)(\\*+{CONTROL})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)\\(\\*+{CONTROL})", "$1")


def format_turns(turns: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """One text per conversation: conv_id, formatted, loss_spans.

    A turn is ``### role: text``, a line feed and ``</turn>``; the role is URL-encoded. Real marks never
    follow a backslash, so texts can be told from marks and read back. ``loss_spans`` lists start and
    end (code points, end exclusive) of each learned text in ``formatted``.

    Turns are ordered by turn, role and text, null first; null role or text is empty; equal rows are
    kept; conv_id null is a conversation; an empty table gives no rows; further columns are ignored.
    A conversation becomes one text, so each must fit into one row.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    role = F.coalesce(F.col("role"), F.lit(""))
    head = F.concat(F.lit(HEAD), F.url_encode(role), F.lit(HEAD_END))
    pieces = (
        turns.select("conv_id", "turn", role.alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .withColumn("head", head)
        .withColumn("body", escape(F.col("text")))
        .withColumn("length", F.char_length("head") + F.char_length("body") + len(TURN_END))
        .withColumn("place", F.row_number().over(order))
        .withColumn("start", F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    )
    start = F.col("start") + F.char_length("head")
    parts = F.array_sort(F.collect_list(F.struct(
        "place", F.concat("head", "body", F.lit(TURN_END)).alias("piece"),
        start.alias("start"), (start + F.char_length("body")).alias("end"),
        (F.col("role") == learned_role).alias("learned"),
    )))
    return pieces.groupBy("conv_id").agg(parts.alias("parts")).select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("formatted"),
        F.transform(
            F.filter("parts", lambda p: p["learned"]),
            lambda p: F.struct(p["start"].cast("int").alias("start"), p["end"].cast("int").alias("end")),
        ).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) and learned texts, from text and spans alone."""
    pieces = F.split("formatted", TURN_END)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    parse = rf"(?s)^{HEAD}([^:]*){HEAD_END}(.*)$"
    return formatted.select(
        "conv_id",
        "formatted",
        F.transform(pieces, lambda p: F.struct(
            F.url_decode(F.regexp_extract(p, parse, 1)).alias("role"),
            unescape(F.regexp_extract(p, parse, 2)).alias("text"),
        )).alias("turns"),
        F.transform("loss_spans", lambda s: unescape(
            F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))).alias("learned"),
    )


def digest(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what can be read back, one row per conversation."""
    back = read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
