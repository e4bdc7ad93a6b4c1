"""Conversations as training text, by DataFrame expressions only.

    <s>[INST]role[/INST]text[/INST]next text of the same role[INST]role[/INST]text</s>

Turns are sorted, adjacent turns of one role become one block, and blocks are concatenated. Control strings inside roles
and texts are escaped by a backslash after their first character, and backslashes are doubled, so the output can be
read back to the very turns it was made from.

The loss mask lists the byte ranges of the assistant texts in the output, one for each text; control strings are never
under it. Conversations are first put together in chunks of ``CHUNK`` turn numbers and then from chunks, so a long one is
spread over many tasks until its single output row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END, ROLE, TEXT = "<s>", "</s>", "[INST]", "[/INST]"
CONTROLS = (BEGIN, END, ROLE, TEXT)
LEARNED_ROLE = "assistant"
CHUNK = 256

_BLOCKS = "array<struct<role: string, texts: array<string>>>"
_SPANS = "array<struct<start: bigint, length: bigint>>"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _size(text: Column) -> Column:
    return F.octet_length(text).cast("bigint")


def _merged(turns: Column) -> Column:
    """Blocks of adjacent turns of one role."""

    def add(blocks: Column, turn: Column) -> Column:
        last = F.element_at(blocks, -1)
        longer = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
        fresh = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        same = (F.size(blocks) > 0) & (F.get(blocks, F.size(blocks) - 1)["role"] == turn["role"])
        return F.when(same, F.concat(F.slice(blocks, 1, F.size(blocks) - 1), F.array(longer))).otherwise(F.concat(blocks, F.array(fresh)))

    return F.aggregate(turns, F.array().cast(_BLOCKS), add)


def _rendered(blocks: Column, goes_on: Column) -> Column:
    def block(b: Column, i: Column) -> Column:
        head = F.when((i == 0) & goes_on, F.lit("")).otherwise(F.concat(F.lit(ROLE), b["role"]))
        return F.concat(head, F.lit(TEXT), F.array_join(b["texts"], TEXT))

    return F.array_join(F.transform(blocks, block), "")


def _learned_spans(turns: Column, role_before: Column) -> Column:
    """Byte ranges of the assistant texts in a chunk, counted from its start."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), role_before.alias("role"), F.array().cast(_SPANS).alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        full = len(ROLE + TEXT) + _size(turn["role"])
        begin = state["at"] + F.when(state["role"].eqNullSafe(turn["role"]), F.lit(len(TEXT)).cast("bigint")).otherwise(full)
        span = F.array(F.struct(begin.alias("start"), _size(turn["text"]).alias("length")))
        spans = F.when(turn["role"] == LEARNED_ROLE, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((begin + _size(turn["text"])).alias("at"), turn["role"].alias("role"), spans.alias("spans"))

    return F.aggregate(turns, start, add, lambda state: state["spans"])


def formatted_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted and loss_spans of every conversation.

    Turns are ordered by turn, then role, then text; a null turn number comes first. Null roles and texts count as
    empty; null conv_ids are one conversation. Repeated rows are turns like any other. An empty table gives no rows.
    Further columns are ignored.
    """
    empty = F.lit("")
    rows = turns.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        escape(F.coalesce(F.col("role").cast("string"), empty)).alias("role"), escape(F.coalesce(F.col("text").cast("string"), empty)).alias("text"),
    )
    rows = rows.withColumn("chunk", F.floor(F.col("turn") / CHUNK))
    chunks = rows.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    order = Window.partitionBy("conv_id").orderBy(F.col("chunk").asc_nulls_first())
    chunks = chunks.withColumn("role_before", F.lag(F.element_at("turns", -1)["role"]).over(order))
    goes_on = F.coalesce(F.col("role_before") == F.col("turns")[0]["role"], F.lit(False))
    parts = chunks.select(
        "conv_id", "chunk", _rendered(_merged(F.col("turns")), goes_on).alias("part"), _learned_spans(F.col("turns"), F.col("role_before")).alias("spans")
    )
    before = F.coalesce(F.sum(_size(F.col("part"))).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + len(BEGIN)
    parts = parts.withColumn("before", before)
    moved = F.transform("spans", lambda s: F.struct((s["start"] + F.col("before")).alias("start"), s["length"].alias("length")))
    parts = parts.select("conv_id", F.struct("chunk", "part", moved.alias("spans")).alias("p"))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("p")).alias("parts"))
    return whole.select(
        "conv_id",
        F.concat(F.lit(BEGIN), F.array_join(F.transform("parts", lambda p: p["part"]), ""), F.lit(END)).alias("formatted"),
        F.flatten(F.transform("parts", lambda p: p["spans"])).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation was made from."""
    body = F.substr(formatted, F.lit(len(BEGIN) + 1), F.length(formatted) - len(BEGIN + END))
    blocks = F.transform(F.split(body, r"\[INST\]"), lambda b: F.split(b, r"\[/INST\]"))
    turn = lambda role, text: F.struct(unescape(role).alias("role"), unescape(text).alias("text"))
    each = F.transform(blocks, lambda b: F.transform(F.slice(b, 2, F.size(b)), lambda text: turn(b[0], text)))
    return F.flatten(each)


def read_learned(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, as it was before it was escaped."""
    cut = lambda data: F.transform(spans, lambda s: F.substring(data, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string"))
    return unescape(F.array_join(F.transform(F.array(formatted.cast("binary")), cut)[0], ""))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, all read back from the output."""
    read = formatted.select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_learned(F.col("formatted"), F.col("loss_spans")).alias("learned")
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"), F.sha2(F.col("learned"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
