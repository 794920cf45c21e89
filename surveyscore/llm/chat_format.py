"""Chat formatting in budgeted windows, with DataFrame functions only.

Prefix sums of turn tokens cut each conversation into turn-aligned spans; a window is the system
turn, a limited repeat of the turns before its span, and the span. The loss mask covers assistant
texts, each once: in the window whose span holds it.

A conversation's rows are shuffled once, by its id; every later step keeps that partitioning.

Template: a turn is ``<s>``, role, newline, text, ``</s>``. A control string inside a text gains a
backslash after its ``<``, one more than it has, which ``unescape`` takes away again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024  # tokens of a window
HISTORY = 128  # tokens of repeated turns
TURN_TOKENS = 4  # of the template, for each turn


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(/?s>)", r"<$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(/?s>)", r"<$1$2")


def escape_role(role: Column) -> Column:
    """Roles stand on one line."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def tokens(text: Column) -> Column:
    """Size of a turn for the budget: its blank-free runs, and the template's share."""
    return F.regexp_count(text, F.lit(r"[^\t\n\x0B\f\r ]+")) + TURN_TOKENS


def format_windows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text", budget: int = BUDGET,
                   history: int = HISTORY) -> DataFrame:
    """Formatted windows of all conversations.

    Returns one row per window: the conversation's id, window (from 1), text, n_tokens, n_repeated
    (leading turns that other windows hold as their own) and loss, the spans of the text that
    targets cover, as start and end in code points. Turns follow ``turn_col``; turns with the same
    number follow role, then text, and repeated rows are turns of their own. A null number comes
    first, a null role or text is empty, rows without an id form one conversation.

    A first turn of role ``system``, if others follow, opens every window. Spans take at most
    ``(budget - system - history) / 2`` tokens up to the start of their last turn; a turn above
    that size has a window of its own, without history if that would exceed the budget, and
    exceeds the budget itself only if it, with the system turn, is larger.
    """
    w = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select(
        "conv", "turn", "role", "text", tokens(F.col("text")).cast("long").alias("size"),
        F.row_number().over(w).alias("pos"), F.lead(F.lit(1)).over(w).isNull().alias("last"),
        F.first("role").over(w).alias("first_role"), F.first("text").over(w).alias("first_text"))
    system = (F.col("pos") == 1) & (F.col("role") == "system") & ~F.col("last")
    has_system = (F.col("first_role") == "system") & ((F.col("pos") > 1) | ~F.col("last"))
    system_size = F.when(has_system, tokens(F.col("first_text"))).otherwise(0)
    rows = rows.select("*", has_system.alias("has_system"), system_size.cast("long").alias("system_size")).where(~system)
    rows = rows.withColumn("quota", F.expr(f"greatest(1L, ({budget} - system_size - {history}) div 2)"))
    rows = rows.select(
        "*", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
        F.sum((F.col("size") > F.col("quota")).cast("long")).over(w).alias("large"))
    rows = rows.withColumn("slot", F.expr("start div quota"))
    span = Window.partitionBy("conv", "slot", "large")
    rows = rows.select(
        "*", F.max(F.col("start") + F.col("size")).over(span).alias("stop"),
        F.dense_rank().over(Window.partitionBy("conv").orderBy("slot", "large")).alias("window"))
    rows = rows.select(
        "conv", "pos", "has_system", "system_size", "size", escape_role(F.col("role")).alias("role"),
        (F.col("role") == "assistant").alias("target"), escape(F.col("text")).alias("text"),
        F.when(F.col("has_system"), escape(F.col("first_text"))).alias("system_text"),
        F.expr(f"""explode(if(stop - start <= {history},
                   array(struct(window, false as repeated), struct(window + 1 as window, true as repeated)),
                   array(struct(window, false as repeated))))""").alias("place"))
    grouped = rows.groupBy("conv", F.col("place.window").alias("window")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "role", "target", "text", "size", F.col("place.repeated").alias("repeated")))).alias("turns"),
        F.max("system_size").alias("system_size"), F.max("system_text").alias("system_text"),
        F.sum("size").alias("size"), F.max(~F.col("place.repeated")).alias("own"))
    return (
        grouped.where("own")  # the turns before a window that does not exist
        .withColumn("turns", F.expr(f"""concat(
            if(system_text is null, array(), array(struct(0 as pos, 'system' as role, false as target,
               system_text as text, system_size as size, window > 1 as repeated))),
            filter(turns, t -> not t.repeated or size + system_size <= {budget}))"""))
        .select(
            F.col("conv").alias(conv_col), "window",
            F.expr(r"array_join(transform(turns, t -> concat('<s>', t.role, '\n', t.text, '</s>')), '')").alias("text"),
            F.expr("aggregate(turns, 0L, (n, t) -> n + t.size)").alias("n_tokens"),
            F.expr("size(filter(turns, t -> t.repeated))").alias("n_repeated"),
            F.expr("""aggregate(turns,
                struct(0 as at, cast(array() as array<struct<start:int,end:int>>) as spans),
                (s, t) -> struct(s.at + length(t.role) + length(t.text) + 8 as at,
                    if(t.target and not t.repeated,
                       concat(s.spans, array(struct(s.at + length(t.role) + 4 as start,
                                                    s.at + length(t.role) + 4 + length(t.text) as end))),
                       s.spans) as spans),
                s -> s.spans)""").alias("loss"))
    )


def read_windows(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Conversations read back from formatted windows.

    Returns one row per conversation: its id, turns (role and text, each turn once, in order),
    loss_texts (what the loss mask covers, unescaped) and formatted_chars.
    """
    own = windows.select(
        F.col(conv_col).alias("conv"), "window", F.length("text").cast("long").alias("chars"),
        F.expr("split(text, '</s>', -1)").alias("parts"), "n_repeated",
        F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]))).alias("loss_texts"))
    turn = lambda p: F.struct(
        unescape_role(F.substring_index(F.substring(p, 4, 1 << 30), "\n", 1)).alias("role"),
        unescape(F.substring(p, F.instr(p, "\n") + 1, F.lit(1 << 30))).alias("text"))
    own = own.withColumn("turns", F.transform(F.expr("slice(parts, n_repeated + 1, size(parts) - 1 - n_repeated)"), turn))
    return own.groupBy(F.col("conv").alias(conv_col)).agg(
        F.sort_array(F.collect_list(F.struct("window", "turns", "loss_texts"))).alias("all"),
        F.sum("chars").alias("formatted_chars"),
    ).select(conv_col, F.flatten("all.turns").alias("turns"), F.flatten("all.loss_texts").alias("loss_texts"), "formatted_chars")
