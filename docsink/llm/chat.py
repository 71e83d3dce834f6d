"""Chat formatting in budgeted windows, native expressions only (operator 3).

Prefix sums of turn tokens cut a conversation into spans at turn borders. With
``g`` half the room for new turns, a turn belongs to the grid cell its prefix
sum falls into, and a turn longer than ``g`` is a span of its own; so a span is
a function of two prefix sums alone (tokens, long turns) and has at most ``2 g``
tokens. No turn is cut: one that is longer than the room exceeds the budget.

A window is the conversation's system turn, as many of the last turns before
the span as ``history`` tokens hold, and the span. Only new assistant turns are
under the loss mask: repeated turns are masked, so every target counts once.

Prefix sums are added up over blocks of turn numbers, and everything else is
keyed by conversation and cell, so a very long conversation is not one task.

A window's text is, per turn, ``<|+role|>``, a line feed, the text and
``<|end|>``, a line feed; ``=`` instead of ``+`` marks a repeated turn. Control
strings inside roles and texts, also those of other common templates, get a
backslash after their first sign, and backslashes are doubled, so unescaping is
exact. ``loss`` lists start and length, in code points, of the parts of the
window's text under the mask.

Defined results: null roles and texts count as empty; turns are ordered by
number, nulls first, then role and text; rows without ``conv_id`` are one
conversation. Repeated rows are repeated turns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 128
OVERHEAD = 4  # tokens of a turn's marks
TURN_BLOCK = 1024  # turn numbers summed up together

END = "<|end|>\n"
# Control strings of this and other chat templates.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_NO_ID = -(1 << 63)


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(c[0] + "\\" + c[1:])), CONTROL, doubled)


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turn_tokens(text: Column) -> Column:
    """Words, and the marks around them."""
    return (F.regexp_count(text, F.lit(r"\S+")) + OVERHEAD).cast("long")


def _placed(conversations: DataFrame, budget: int, history: int) -> DataFrame:
    """Turns with ``p``, the tokens before them, and their span."""
    turns = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_ID)).alias("c"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = turns.withColumn("tokens", turn_tokens(F.col("text")))
    block = F.coalesce(F.call_function("div", F.col("turn"), F.lit(TURN_BLOCK)), F.lit(_NO_ID))
    turns = turns.withColumn("block", F.when(F.col("turn") < 0, block - 1).otherwise(block))
    is_system = F.col("role") == "system"

    # What a conversation holds before a block, and its system turn.
    system = F.min(F.when(is_system, F.struct(F.col("turn"), F.col("text"), F.col("tokens"))))
    blocks = turns.groupBy("c", "block").agg(F.sum("tokens").alias("in_block"), system.alias("system"))
    whole = Window.partitionBy("c")
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first_system = F.min("system").over(whole)
    room = F.lit(budget - history) - F.coalesce(first_system["tokens"], F.lit(0))
    blocks = blocks.select(
        "c",
        "block",
        F.coalesce(F.sum("in_block").over(earlier), F.lit(0)).alias("before"),
        F.greatest(F.call_function("div", room, F.lit(2)), F.lit(max(history, OVERHEAD))).alias("g"),
    )
    in_block = Window.partitionBy("c", "block").orderBy(F.asc_nulls_first("turn"), "role", "text")
    up_to = in_block.rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("inside", F.coalesce(F.sum("tokens").over(up_to), F.lit(0)))
    turns = turns.join(blocks, ["c", "block"]).withColumn("p", F.col("before") + F.col("inside"))

    # Long turns before a turn are counted inside its cell: a cell border ends a span anyway.
    turns = turns.withColumn("cell", F.call_function("div", F.col("p"), F.col("g")))
    is_long = (F.col("tokens") > F.col("g")).cast("int")
    in_cell = Window.partitionBy("c", "cell").orderBy("p")
    longs = F.coalesce(F.sum(is_long).over(in_cell.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turns = turns.withColumn("part", 2 * longs + is_long)
    return turns.withColumn("span", F.min("p").over(Window.partitionBy("c", "cell", "part")))


def format_windows(conversations: DataFrame, *, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Windows of all conversations: ``conv_id, span, text, loss, tokens``."""
    if history < 0 or budget < 2 * history + 2 * OVERHEAD:
        raise ValueError("the budget must hold twice the history")
    turns = _placed(conversations, budget, history).select("c", "cell", "span", "p", "tokens", "role", "text")
    spans = turns.groupBy("c", "cell", "span").agg(F.count("*").alias("turns")).drop("turns")
    system = turns.where("role = 'system'").groupBy("c").agg(
        F.min(F.struct("p", "tokens", "role", "text")).alias("system")
    )

    own = turns.select("c", "span", "p", "tokens", "role", "text", F.lit(True).alias("new"))
    near = F.explode(F.array(F.col("cell"), F.col("cell") + 1)).alias("cell")
    # A span that starts within ``history`` of a turn starts in the turn's cell or the next.
    repeated = (
        turns.select("c", near, "p", "tokens", "role", "text")
        .join(spans, ["c", "cell"])
        .where((F.col("span") > F.col("p")) & (F.col("span") - F.col("p") <= history))
        .join(system.select("c", F.col("system.p").alias("q")), "c", "left")
        .where(F.col("q").isNull() | (F.col("p") != F.col("q")))
    )
    kept = spans.join(system, "c").where(F.col("system.p") < F.col("span")).select("c", "span", "system.*")
    again = F.lit(False).alias("new")
    entries = own.unionByName(repeated.select("c", "span", "p", "tokens", "role", "text", again))
    entries = entries.unionByName(kept.withColumn("new", again))

    head = F.concat(F.lit("<|"), F.when(F.col("new"), "+").otherwise("="), escaped(F.col("role")), F.lit("|>\n"))
    entries = entries.select(
        "c", "span", "p", "new", "tokens", "role", head.alias("head"), escaped(F.col("text")).alias("body")
    ).withColumn("piece", F.concat("head", "body", F.lit(END)))
    before = Window.partitionBy("c", "span").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)) + F.char_length("head")
    target = F.col("new") & (F.col("role") == "assistant") & (F.char_length("body") > 0)
    mask = F.when(target, F.struct(start.cast("int").alias("start"), F.char_length("body").alias("length")))
    gathered = (
        entries.withColumn("mask", mask)
        .groupBy("c", "span")
        .agg(F.sort_array(F.collect_list(F.struct("p", "piece", "mask"))).alias("turns"), F.sum("tokens").alias("tokens"))
    )
    return gathered.select(
        F.when(F.col("c") != _NO_ID, F.col("c")).alias("conv_id"),
        "span",
        F.array_join(F.col("turns.piece"), "").alias("text"),
        F.filter("turns.mask", lambda m: m.isNotNull()).alias("loss"),
        "tokens",
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """What the texts of windows say: new turns as ``turns`` (role, text), and ``targets``."""
    pieces = F.split("text", r"<\|end\|>\n")
    new = F.filter(pieces, lambda p: F.substring(p, 3, 1) == "+")

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substr(piece, F.lit(4)), "|>\n", 1)
        body = F.substr(piece, F.char_length(role) + 7)
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    target = F.transform("loss", lambda m: unescaped(F.substr(F.col("text"), m["start"] + 1, m["length"])))
    return windows.withColumn("turns", F.transform(new, turn)).withColumn("targets", target)


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Read the windows back, one row per conversation."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = read_windows(windows).select(
        "conv_id",
        "span",
        F.size("turns").cast("long").alias("n"),
        F.array_join(lines, "").alias("said"),
        F.array_join("targets", "").alias("learnt"),
        F.char_length("text").cast("long").alias("chars"),
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("span", "said", "learnt"))).alias("w"),
        F.sum("chars").alias("formatted_chars"),
    )
    said, learnt = F.array_join(F.col("w.said"), ""), F.array_join(F.col("w.learnt"), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        "formatted_chars",
    )
