"""Chat formatting: typed content parts flattened into one marked text per turn, read back without loss.

A turn is an ordered array of parts (`PARTS`). The visitor renders each part by its kind: text is
escaped and kept, image, audio and document parts become a placeholder each, in order, and leave a
reference with the number of tokens that the placeholder stands for. Everything is built-in column
functions; the only shuffle brings a conversation's turns together to number them.

Defined results: null text or role is empty; a part of unknown kind counts as text; a turn without
parts is an empty turn; rows of equal turn number are ordered by role and content; a null `conv_id`
is a conversation of its own; other columns of the input are ignored. A turn is one output row, so
a conversation of any length is never held as one value unless `assemble` or `read_back` asks for it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PARTS = "array<struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>>"

ATTACHMENTS = ("image", "audio", "document")
# what follows the first character of a control string; the template uses no other marks
_REST = r"(?:/?INST\]|NL\]|/?s>|(?:image|audio|document)>)"
_CONTROL = rf"([\[<])(\\*)(?={_REST})"
_ESCAPED = rf"([\[<])\\(\\*)(?={_REST})"
_PLACEHOLDER = "<(?:image|audio|document)>"
_TURN = r"(?s)\[INST\].*?\[/INST\]\n|<s>.*?</s>\n"
_INNER = r"(?s)^(?:\[INST\]|<s>)(.*)(?:\[/INST\]|</s>)\n$"


def escape(text: Column) -> Column:
    """A backslash after the first character of every control string, one more where some stand already."""
    return F.regexp_replace(text, _CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    """Inverse of `escape`."""
    return F.regexp_replace(text, _ESCAPED, "$1$2")


def text_parts(text: Column) -> Column:
    """A plain text as an array of one text part."""
    return F.array(F.struct(
        F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("uri"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    ))


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["kind"].isin(*ATTACHMENTS), F.lit(False))


def _render(part: Column) -> Column:
    return F.when(_is_attachment(part), F.concat(F.lit("<"), part["kind"], F.lit(">"))).otherwise(
        escape(F.coalesce(part["text"], F.lit("")))
    )


def _tokens(patch: int, audio_rate: float, page_tokens: int, unknown: int) -> Callable[[Column], Column]:
    def cells(side: Column) -> Column:
        return F.ceil(side / F.lit(patch))

    def tokens(part: Column) -> Column:
        n = (
            F.when(part["kind"] == "image", cells(part["width"]) * cells(part["height"]))
            .when(part["kind"] == "audio", F.ceil(part["seconds"] * F.lit(audio_rate)))
            .otherwise(part["pages"] * F.lit(page_tokens))
        )
        return F.coalesce(n, F.lit(unknown)).cast("bigint")

    return tokens


def format_turns(
    turns: DataFrame, loss_role: str = "assistant", patch: int = 14, audio_rate: float = 25.0,
    page_tokens: int = 512, unknown: int = 256,
) -> DataFrame:
    """One row per turn of (`conv_id`, `turn`, `role`, `parts`).

    `position` (from 1) and `start` (code points of all earlier pieces) place `piece` in the
    conversation's text; `mask_at`, `mask_chars` (null outside `loss_role`) are the loss mask inside
    the piece; `attachments` lists (kind, uri, tokens) in placeholder order.
    """
    tokens = _tokens(patch, audio_rate, page_tokens, unknown)
    role = F.coalesce(F.col("role"), F.lit(""))
    parts = F.coalesce(F.col("parts"), F.array().cast(PARTS))
    trained = role == loss_role
    head = F.concat(
        F.when(trained, F.lit("<s>")).otherwise(F.lit("[INST]")), F.replace(escape(role), F.lit("\n"), F.lit("[NL]")), F.lit("\n")
    )
    tail = F.when(trained, F.lit("</s>\n")).otherwise(F.lit("[/INST]\n"))
    rendered = turns.select(
        "conv_id", "turn", trained.alias("_trained"), head.alias("_head"), tail.alias("_tail"),
        F.array_join(F.transform(parts, _render), "").alias("_body"),
        F.transform(F.filter(parts, _is_attachment), lambda p: F.struct(p["kind"].alias("kind"), p["uri"].alias("uri"), tokens(p).alias("tokens"))).alias("attachments"),
    ).select(
        "conv_id", "turn", "attachments", F.concat("_head", "_body", "_tail").alias("piece"),
        F.when(F.col("_trained"), F.length("_head")).alias("mask_at"), F.when(F.col("_trained"), F.length("_body")).alias("mask_chars"),
    )
    ordered = W.partitionBy("conv_id").orderBy("turn", "piece", F.to_json("attachments"))
    before = ordered.rowsBetween(W.unboundedPreceding, -1)
    return rendered.select(
        "conv_id", "turn", F.row_number().over(ordered).alias("position"),
        F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)).cast("bigint").alias("start"),
        "piece", "mask_at", "mask_chars", "attachments",
    )


def assemble(formatted: DataFrame) -> DataFrame:
    """One row per conversation: its text, the loss mask as (start, chars) spans, its attachments."""
    mask = F.filter("_turns", lambda t: t["mask_at"].isNotNull())
    return _grouped(formatted).select(
        "conv_id",
        F.array_join(F.transform("_turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(mask, lambda t: F.struct((t["start"] + t["mask_at"]).alias("start"), t["mask_chars"].cast("bigint").alias("chars"))).alias("loss_spans"),
        F.flatten(F.transform("_turns", lambda t: t["attachments"])).alias("attachments"),
    )


def _grouped(formatted: DataFrame) -> DataFrame:
    turn = F.struct("position", "start", "piece", "mask_at", "mask_chars", "attachments")
    return formatted.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("_turns"))


def plain_text(body: Column) -> Column:
    """The texts of a rendered body, unescaped piece by piece between its placeholders."""
    return F.array_join(F.transform(F.split(body, _PLACEHOLDER, -1), unescape), "")


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, parsed from the assembled text alone: `turns` as (role, text); and `loss`,
    the text under the mask; and `formatted_chars`."""

    def parse(turn: Column) -> Column:
        inner = F.regexp_extract(turn, _INNER, 1)
        name = F.substring_index(inner, "\n", 1)
        role = unescape(F.replace(name, F.lit("[NL]"), F.lit("\n")))
        return F.struct(role.alias("role"), plain_text(F.substr(inner, F.length(name) + 2)).alias("text"))

    masked = F.filter("_turns", lambda t: t["mask_at"].isNotNull())
    whole = _grouped(formatted).select(
        "conv_id",
        F.array_join(F.transform("_turns", lambda t: t["piece"]), "").alias("_text"),
        F.array_join(F.transform(masked, lambda t: plain_text(F.substr(t["piece"], t["mask_at"] + 1, t["mask_chars"]))), "").alias("loss"),
        F.size(F.flatten(F.transform("_turns", lambda t: t["attachments"]))).cast("bigint").alias("n_attachments"),
    )
    return whole.select(
        "conv_id", F.transform(F.regexp_extract_all("_text", F.lit(_TURN), F.lit(0)), parse).alias("turns"), "loss",
        F.length("_text").cast("bigint").alias("formatted_chars"), "n_attachments",
    )


def digests(read: DataFrame) -> DataFrame:
    """Digest columns of `read_back`, to compare a corpus without moving its texts."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
