"""Conversations as one training text each, with the spans that the loss counts.

A formatted conversation is a row of blocks `<|turn|>role<|text|>text<|next|>text<|end|>`: one
block for each run of neighbouring turns with the same role, its texts parted by `<|next|>`.
In roles and texts a backslash goes before every backslash and before a bar that follows `<`,
so no text can hold a mark, and dropping those backslashes gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.llm.arrays import running_totals

TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"\\|(?<=<)\|", r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learned: str = "assistant",
) -> DataFrame:
    """One row a conversation: its id, n_turns, formatted, and loss_spans.

    Rows are ordered by turn, then role, then text, nulls first; repeated rows stay repeated.
    A null text or role counts as empty; rows with a null conversation form one conversation.
    loss_spans has {start, end}, code points with the end exclusive, for each text of the
    `learned` role, as escaped, in order. Extra columns don't reach the result; an empty frame
    gives no rows. A conversation is one training text, so its turns meet in one row.
    """
    rows = turns.select(
        F.col(f"`{conversation}`").alias(conversation),
        F.struct(
            F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text")
        ).alias("t"),
    )
    sorted_turns = rows.groupBy(conversation).agg(F.sort_array(F.collect_list("t")).alias("ts"))
    plain = sorted_turns.select(
        conversation,
        F.transform(
            "ts",
            lambda t: F.struct(
                escape(t["role"]).alias("role"),
                escape(t["text"]).alias("text"),
                (F.coalesce(t["role"], F.lit("")) == learned).alias("learned"),
            ),
        ).alias("ts"),
    )
    # A run of one role starts where the role differs from the one before.
    starts = plain.selectExpr(
        f"`{conversation}`",
        "ts",
        """filter(sequence(0, size(ts) - 1),
                  i -> i = 0 OR ts[i].role <> ts[greatest(i - 1, 0)].role) AS starts""",
    )
    merged = starts.selectExpr(
        f"`{conversation}`",
        "ts",
        """transform(starts, (s, k) -> struct(
             ts[s].role AS role,
             ts[s].learned AS learned,
             transform(slice(ts, s + 1, coalesce(get(starts, k + 1), size(ts)) - s), t -> t.text) AS texts
           )) AS blocks""",
    )
    # What stands before each text: the block's opening for its first, the parting mark else.
    pieces = merged.selectExpr(
        f"`{conversation}`",
        "size(ts) AS n_turns",
        "blocks",
        f"""flatten(transform(blocks, (b, k) -> transform(b.texts, (x, i) -> struct(
              CAST(if(i = 0, if(k = 0, 0, {len(END)}) + {len(TURN) + len(TEXT)} + length(b.role), {len(NEXT)}) AS BIGINT) AS lead,
              CAST(length(x) AS BIGINT) AS chars,
              b.learned AS learned)))) AS pieces""",
    )
    placed = pieces.selectExpr(
        "*", "transform(pieces, p -> p.lead + p.chars) AS steps"
    ).selectExpr("*", f"{running_totals('steps')} AS befores")
    return placed.selectExpr(
        f"`{conversation}`",
        "CAST(n_turns AS BIGINT) AS n_turns",
        f"""array_join(transform(blocks, b -> concat('{TURN}', b.role, '{TEXT}',
              array_join(b.texts, '{NEXT}'), '{END}')), '') AS formatted""",
        """filter(transform(pieces, (p, i) -> if(p.learned,
             struct(befores[i] + p.lead AS start, befores[i] + p.lead + p.chars AS end), NULL)),
             s -> s IS NOT NULL) AS loss_spans""",
    )


def read_back(formatted: Column) -> Column:
    """The turns {role, text} of a formatted conversation, as they came in.

    Nulls come back as the empty texts they were formatted as; a null conversation is null, an
    empty one has no turns.
    """
    blocks = F.filter(F.split(formatted, r"<\|end\|>", -1), lambda b: b != "")
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.get(F.split(b, r"<\|text\|>", -1), F.lit(1)), r"<\|next\|>", -1),
                lambda x: F.struct(
                    unescape(F.get(F.split(F.substring(b, len(TURN) + 1, 1 << 30), r"<\|text\|>", -1), F.lit(0))).alias("role"),
                    unescape(x).alias("text"),
                ),
            ),
        )
    )
