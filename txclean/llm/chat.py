"""Chat formatting in budgeted windows, with a mask of what is to be learnt.

Each turn becomes `<s>[INST] role [/INST] text </s>`. Where a role or text holds one of
the control strings, backslashes are put behind its first character, one more than
stood there, so that no control string is left and the text can be read back exactly.

A window holds whole turns. Running sums of turn tokens, in the order of the turns,
deal them out: a budget's worth of tokens is one bin, a turn belongs to the bin in
which it ends, and a turn that crosses into its bin gets a window of its own. So no
window has more new tokens than the budget, unless one turn alone is longer. Ahead of
its new turns a window repeats the system turn that opens the conversation and the
latest turns before it that fit in the history allowance; what is repeated is masked.
Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txclean.llm.common import narrow

# The control strings of the template.
OPEN, HEAD_END, CLOSE = "<s>[INST] ", " [/INST] ", " </s>"
CONTROLS = r"([<\[])(\\*)(/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"

#: Tokens that the template adds to a turn.
OVERHEAD = 6


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROLS, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _tokens(text: Column) -> Column:
    """Words and single marks; an estimate which needs no tokenizer."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")).cast("long")


def format_conversations(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    budget: int = 2048,
    history: int = 512,
    learn: str = "assistant",
) -> DataFrame:
    """One row per window: conv_id, window (from 0, in order), formatted, n_repeated (how
    many of its first turns are repeats), n_turns, spans.

    `spans` are the places under the loss mask, as (first code point from 0, length):
    the texts of new turns with role `learn`. Each such turn is new in just one window,
    and every turn is. `budget` bounds the tokens of new turns, `history` those of the
    repeated ones; the system turn comes on top. Turns are taken in the order of the
    turn column, then role, then text; rows repeated in full are turns like others.
    Null roles and texts are empty, null turns come first, and null conversation ids
    make one conversation. An empty table gives no window.
    """
    rows = narrow(df, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col).select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    turns = (
        rows.withColumn("tokens", _tokens(F.col("role")) + _tokens(F.col("text")) + OVERHEAD)
        .withColumn("at", F.row_number().over(in_order))
        .withColumn("end", F.sum("tokens").over(so_far))
        .withColumn("start", F.col("end") - F.col("tokens"))
        .withColumn("bin", F.floor((F.col("end") - 1) / F.lit(budget)))
        .withColumn("crosses", F.col("start") < F.col("bin") * budget)
        .withColumn("slot", F.col("bin") * 2 + F.when(F.col("crosses"), 0).otherwise(1))
        .withColumn("last_slot", F.lag("slot").over(in_order))
        .withColumn(
            "opens", F.col("last_slot").isNull() | (F.col("last_slot") != F.col("slot"))
        )
        .withColumn("window", F.sum(F.col("opens").cast("int")).over(so_far) - 1)
        .select(
            "conv_id",
            "window",
            "at",
            "start",
            "end",
            "opens",
            F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(HEAD_END)).alias("head"),
            escape(F.col("text")).alias("body"),
            (F.col("role") == learn).alias("learnt"),
            (F.col("role") == "system").alias("system"),
        )
    )
    new = turns.withColumn("repeated", F.lit(False))
    windows = turns.where("opens").select(
        F.col("conv_id").alias("w_conv"),
        F.col("window").alias("w"),
        F.col("start").alias("w_start"),
        F.col("at").alias("w_at"),
        F.floor(F.col("start") / history).alias("w_part"),
    ).where("w > 0")
    # A turn can be history of the windows that start less than `history` tokens after
    # it; those lie in its own part of the running sum or in the next. A part holds few
    # turns, as each has OVERHEAD tokens at least.
    part = F.floor(F.col("start") / history)
    past = (
        turns.where(F.col("end") - F.col("start") <= history)
        .withColumn("part", F.explode(F.array(part, part + 1)))
        .join(
            windows,
            F.col("conv_id").eqNullSafe(F.col("w_conv"))
            & (F.col("part") == F.col("w_part"))
            & (F.col("end") <= F.col("w_start"))
            & (F.col("w_start") - F.col("start") <= history),
        )
    )
    first = turns.where((F.col("at") == 1) & F.col("system")).select(
        F.col("conv_id").alias("s_conv"), F.col("start").alias("s_start"), F.col("end").alias("s_end"),
        "head", "body", "at", "learnt", "system", "opens",
    )
    # The first turn is repeated as the system turn where it isn't history already.
    system = first.join(
        windows,
        F.col("s_conv").eqNullSafe(F.col("w_conv"))
        & ~(
            (F.col("s_end") - F.col("s_start") <= history)
            & (F.col("w_start") - F.col("s_start") <= history)
        ),
    )
    columns = ["conv_id", "window", "at", "head", "body", "learnt", "repeated"]
    repeats = past.select(
        "conv_id", F.col("w").alias("window"), "at", "head", "body", "learnt", F.lit(True).alias("repeated")
    ).unionByName(
        system.select(
            F.col("s_conv").alias("conv_id"), F.col("w").alias("window"), "at", "head", "body", "learnt",
            F.lit(True).alias("repeated"),
        )
    )
    pieces = new.select(*columns).unionByName(repeats)
    whole = pieces.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.struct("at", "head", "body", "learnt", "repeated"))).alias("t")
    )
    pieces_of = F.transform("t", lambda t: F.concat(t.head, t.body, F.lit(CLOSE)))
    # Where each turn starts: running sum of lengths, folded over the turns of the window.
    spans = F.aggregate(
        "t",
        F.struct(
            F.lit(0).cast("long").alias("at"),
            F.expr("CAST(array() AS ARRAY<STRUCT<start: BIGINT, length: BIGINT>>)").alias("spans"),
        ),
        lambda acc, t: F.struct(
            (acc.at + F.length(t.head) + F.length(t.body) + len(CLOSE)).alias("at"),
            F.when(
                t.learnt & ~t.repeated,
                F.concat(
                    acc.spans,
                    F.array(
                        F.struct(
                            (acc.at + F.length(t.head)).alias("start"),
                            F.length(t.body).cast("long").alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(acc.spans)
            .alias("spans"),
        ),
        lambda acc: acc.spans,
    )
    return whole.select(
        "conv_id",
        "window",
        F.array_join(pieces_of, "").alias("formatted"),
        F.size(F.filter("t", lambda t: t.repeated)).alias("n_repeated"),
        F.size("t").alias("n_turns"),
        spans.alias("spans"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """From windows to conversations: conv_id, turns (role, text) in order without the
    repeats, learnt (the text under the mask), formatted_chars; all read from the
    formatted strings and spans."""
    turn = F.split(F.col("formatted"), r" </s>")
    new = F.slice(turn, F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))
    read = F.transform(
        new,
        lambda t: F.struct(
            unescape(
                F.substring_index(F.substring(t, F.lit(len(OPEN) + 1), F.length(t)), HEAD_END, 1)
            ).alias("role"),
            unescape(
                F.substring(t, F.instr(t, HEAD_END) + len(HEAD_END), F.length(t))
            ).alias("text"),
        ),
    )
    learnt = F.array_join(
        F.transform(
            "spans",
            lambda s: unescape(
                F.substring(F.col("formatted"), (s.start + 1).cast("int"), s.length.cast("int"))
            ),
        ),
        "",
    )
    parts = windows.select(
        "conv_id", "window", read.alias("turns"), learnt.alias("learnt"), F.length("formatted").alias("chars")
    )
    # A conversation is put together from its windows, which are far fewer than turns.
    return (
        parts.groupBy("conv_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("window", "turns", "learnt"))).alias("w"),
            F.sum("chars").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            F.flatten(F.transform("w", lambda w: w.turns)).alias("turns"),
            F.array_join(F.transform("w", lambda w: w.learnt), "").alias("learnt"),
            "formatted_chars",
        )
    )
