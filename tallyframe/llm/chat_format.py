"""Chat formatting of typed message parts, in native columns only.

A message is a list of parts. Each kind of part is flattened by its own visitor:
texts are escaped, images, audio and documents become placeholders in place,
with a reference and the number of tokens the placeholder stands for.

Template: ``<|im_start|>role<|im_sep|>body<|im_end|>`` and a line feed per turn.
Control strings begin with ``<|``, so one backslash is put between ``<`` and
``|`` inside texts and roles (and one more where backslashes already stand
there). No escaped text holds ``<|``, and taking one backslash out restores it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
PART_TYPE = (
    "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit("<(\\\\*)\\|"), F.lit("<\\\\$1|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit("<\\\\(\\\\*)\\|"), F.lit("<$1|"))


def image_tokens(part: Column, patch: int = 28) -> Column:
    return F.ceil(part["width"] / patch) * F.ceil(part["height"] / patch)


def audio_tokens(part: Column, per_second: int = 25) -> Column:
    return F.ceil(part["seconds"] * per_second)


def document_tokens(part: Column, per_page: int = 256) -> Column:
    return part["pages"] * per_page


#: Tokens a part's placeholder expands to, per kind of attachment.
ATTACHMENTS: dict[str, Callable[[Column], Column]] = {
    "image": image_tokens,
    "audio": audio_tokens,
    "document": document_tokens,
}


def text_part(text: Column) -> Column:
    """A list of one text part."""
    fields = {"type": F.lit("text"), "text": text}
    types = [f.split(":") for f in PART_TYPE.removeprefix("struct<").removesuffix(">").split(",")]
    return F.array(F.struct(*(fields.get(n, F.lit(None)).cast(t).alias(n) for n, t in types)))


def _visit(part: Column) -> Column:
    """The string a part leaves in its message; unknown kinds and null parts leave none."""
    shown = F.when(part["type"] == "text", escape(F.coalesce(part["text"], F.lit(""))))
    for kind in ATTACHMENTS:
        shown = shown.when(part["type"] == kind, F.lit(f"<|{kind}|>"))
    return shown.otherwise(F.lit(""))


def _tokens(part: Column) -> Column:
    counted = F.when(F.lit(False), F.lit(0))
    for kind, tokens in ATTACHMENTS.items():
        counted = counted.when(part["type"] == kind, tokens(part))
    return F.coalesce(counted, F.lit(0)).cast("long")


def format_chat(
    messages: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str = "parts",
    loss_roles: Sequence[str] = ("assistant",),
) -> DataFrame:
    """One row per conversation, its turns in order.

    Returns ``(conv_col, n_turns, formatted, turns, attachments,
    placeholder_tokens)``: ``turns`` holds per turn the code point spans
    ``(start, end)`` of the turn and ``(loss_start, loss_end)`` of its body if
    loss is taken there (empty spans elsewhere); ``attachments`` lists ``(turn,
    part, type, ref, n_tokens)`` in order of their placeholders.

    A null conversation id is a conversation; turns order by ``turn_col`` (null
    first), then role, then content, so equal and repeated turns all stay, in a
    fixed order; null roles and texts are empty; other columns are left out; an
    empty table gives no rows. A conversation is one string, so one task builds
    it; rows are formatted before the only shuffle.
    """
    role = F.coalesce(F.col("_role"), F.lit(""))
    parts = F.coalesce(F.col("_parts"), F.array().cast(f"array<{PART_TYPE}>"))
    rows = messages.select(
        F.col(conv_col).alias("_conv"),
        F.col(turn_col).alias("_turn"),
        F.col(role_col).alias("_role"),
        F.col(parts_col).cast(f"array<{PART_TYPE}>").alias("_parts"),
    ).select(
        "_conv",
        "_turn",
        role.alias("_role"),
        F.concat(F.lit(START), escape(role), F.lit(SEPARATOR)).alias("_head"),
        F.array_join(F.transform(parts, _visit), "").alias("_body"),
        F.filter(
            F.transform(
                parts,
                lambda p, i: F.struct(
                    i.alias("part"), p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("n_tokens")
                ),
            ),
            lambda a: a["type"].isin(list(ATTACHMENTS)),
        ).alias("_attached"),
    )
    # One exchange serves both the running offsets and the grouping.
    order = Window.partitionBy("_conv").orderBy("_turn", "_role", "_body", F.to_json("_attached"))
    length = F.length("_head") + F.length("_body") + len(END)
    end = F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = rows.withColumn("_at", F.row_number().over(order)).withColumn("_end", end)
    loss = F.col("_role").isin(list(loss_roles))
    start = F.col("_end") - length
    body = start + F.length("_head")
    turn = F.struct(
        F.col("_at").alias("at"),
        start.alias("start"),
        F.col("_end").alias("end"),
        body.alias("loss_start"),
        F.when(loss, body + F.length("_body")).otherwise(body).alias("loss_end"),
        F.concat("_head", "_body", F.lit(END)).alias("shown"),
        F.transform("_attached", lambda a: F.struct((F.col("_at") - 1).alias("turn"), a["part"].alias("part"), a["type"].alias("type"), a["ref"].alias("ref"), a["n_tokens"].alias("n_tokens"))).alias("attached"),
    )
    grouped = placed.groupBy("_conv").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    spans = ("start", "end", "loss_start", "loss_end")
    attachments = F.flatten(F.transform("_turns", lambda t: t["attached"]))
    return grouped.select(
        F.col("_conv").alias(conv_col),
        F.size("_turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("_turns", lambda t: t["shown"]), "").alias("formatted"),
        F.transform("_turns", lambda t: F.struct(*(t[s].alias(s) for s in spans))).alias("turns"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, a: n + a["n_tokens"]).alias("placeholder_tokens"),
    )


def read_chat(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Read a formatted conversation back: ``(conv_col, turns, loss_text, formatted_chars)``.

    ``turns`` holds ``(role, text)`` as they were before escaping (placeholders
    stay), ``loss_text`` all text under the loss mask. Every turn is cut out of
    its own block, so the work is linear in the conversation.
    """
    blocks = F.filter(F.split("formatted", _literal(END)), lambda b: b != "")
    bare = formatted.select(
        conv_col, F.col("turns").alias("_spans"), blocks.alias("_blocks"), F.length("formatted").alias("_chars")
    )
    cut = lambda block: F.split(F.substr(block, F.lit(len(START) + 1)), _literal(SEPARATOR))
    turns = F.transform(
        "_blocks",
        lambda b: F.struct(unescape(F.get(cut(b), F.lit(0))).alias("role"), unescape(F.get(cut(b), F.lit(1))).alias("text")),
    )
    masked = F.zip_with(
        "_blocks",
        "_spans",
        lambda b, s: unescape(
            F.substr(b, (s["loss_start"] - s["start"] + 1).cast("int"), (s["loss_end"] - s["loss_start"]).cast("int"))
        ),
    )
    return bare.select(
        conv_col,
        turns.alias("turns"),
        F.array_join(masked, "").alias("loss_text"),
        F.col("_chars").cast("long").alias("formatted_chars"),
    )


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"
