"""Chat examples by prefix-target expansion.

Every assistant turn becomes an example of its own: the text holds all turns before it as
context and the reply as target, and only the reply's characters are trainable. What
follows the last reply (or a conversation without any) becomes one more example without a
target, so the examples together hold every turn.

A turn is written ``<|im_start|>role<|im_sep|>text<|im_end|>``. Control strings inside
roles and texts get one backslash after their first character, or one more where some are
there already (``</s>`` becomes ``<\\/s>``, ``<\\/s>`` becomes ``<\\\\/s>``); taking one away
gives the text back, and no control string is left.

The shuffle carries every turn once. Examples are cut from their conversation's text one
after another, so the quadratic size of all contexts is streamed, never held. A
conversation is one value (its last example is), so it has to fit a Spark string of 2 GB;
nothing larger than one conversation meets in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.text import whole

# The marks of a turn, and the other strings that chat models read as control
# strings: anything that begins <|, the sentence marks and the instruction marks.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TARGET_ROLE = "assistant"
_FIRST, _REST = r"([<\[])", r"(\||/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _FIRST + r"(\\*)" + _REST, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _FIRST + r"\\(\\*)" + _REST, "$1$2$3")


def formatted_turns(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per turn: conv, nr, n_turns, is_target, piece, and the code points at which its
    text (``start``) and the next piece (``end``) begin."""
    role, text = whole(role_col), whole(text_col)
    rows = conversations.select(
        F.col(id_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        (role == TARGET_ROLE).alias("is_target"),
        F.concat(F.lit(START), escape(role), F.lit(SEP)).alias("head"),
        F.concat(escape(text), F.lit(END)).alias("tail"),
    )
    conv = Window.partitionBy("conv")
    in_order = conv.orderBy(F.asc_nulls_last("turn"), F.asc("head"), F.asc("tail"))
    long = (F.length("head") + F.length("tail")).cast("bigint")
    placed = rows.withColumns(
        {
            "nr": F.row_number().over(in_order),
            "n_turns": F.count("*").over(conv),
            "end": F.sum(long).over(in_order.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    # The two halves are joined after the shuffle, which so carries them once.
    return placed.select(
        "conv",
        "nr",
        "n_turns",
        "is_target",
        F.concat("head", "tail").alias("piece"),
        (F.col("end") - F.length("tail")).alias("start"),
        "end",
    )


def examples(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per example: conv, example (from 1), turns, is_last, text, loss_start, loss_end.

    The span [loss_start, loss_end) counts code points of ``text`` and covers the reply alone;
    it is null in the example without a target. ``turns`` are those the text holds;
    ``is_last`` marks the example that holds them all.

    Turns are ordered by number (null last), then role and text as written, so ties and repeated rows
    have a defined order and all stay. A null role or text is empty; only the role
    ``assistant`` is a target. Rows without a conversation form one with a null id. An empty
    reply is a target of length 0. An empty table gives no rows; other columns are not read.
    """
    turns = formatted_turns(conversations, id_col, turn_col, role_col, text_col)
    last = F.col("nr") == F.col("n_turns")
    cut = F.when(
        F.col("is_target") | last,
        F.struct("nr", last.alias("is_last"), "end", F.when(F.col("is_target"), F.col("start")).alias("start")),
    )
    whole_conversations = turns.groupBy("conv").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nr", "piece"))), lambda p: p["piece"]), "").alias("all_turns"),
        F.array_sort(F.collect_list(cut)).alias("cuts"),
    )
    cuts = whole_conversations.select("conv", "all_turns", F.posexplode("cuts").alias("at", "cut"))
    end = F.col("cut.end").cast("int")
    return cuts.select(
        "conv",
        (F.col("at") + 1).alias("example"),
        F.col("cut.nr").alias("turns"),
        F.col("cut.is_last").alias("is_last"),
        F.substring("all_turns", F.lit(1), end).alias("text"),
        F.col("cut.start").alias("loss_start"),
        F.when(F.col("cut.start").isNotNull(), F.col("cut.end") - len(END)).alias("loss_end"),
    )


def parse_turns(text: Column) -> Column:
    """The (role, text) pairs that an example's text holds, as they were before escaping."""
    written = F.split(text, END.replace("|", r"\|"), -1)
    written = F.slice(written, F.lit(1), F.size(written) - 1)
    return F.transform(
        written,
        lambda t: F.struct(
            unescape(F.substring_index(F.substr(t, F.lit(len(START) + 1)), SEP, 1)).alias("role"),
            unescape(F.substring_index(t, SEP, -1)).alias("text"),
        ),
    )


def replies(found: DataFrame) -> DataFrame:
    """Adds ``reply``: what the loss mask of an example covers, unescaped; null without one."""
    start, end = F.col("loss_start").cast("int"), F.col("loss_end").cast("int")
    return found.withColumn("reply", unescape(F.substr("text", start + 1, end - start)))


def digests(found: DataFrame) -> DataFrame:
    """What the examples of a conversation hold, read back from their texts: conv, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars (of all examples), n_examples."""
    pairs = F.when(F.col("is_last"), parse_turns(F.col("text")))
    line = F.transform(pairs, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = replies(found).select(
        "conv",
        "example",
        "reply",
        F.size(pairs).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("text").cast("bigint").alias("chars"),
        F.col("loss_start").isNotNull().alias("has_reply"),
    )
    said = F.array_sort(F.collect_list(F.when(F.col("has_reply"), F.struct("example", "reply"))))
    learned = F.array_join(F.transform(said, lambda r: r["reply"]), "")
    return read.groupBy("conv").agg(
        F.max("n_turns").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.coalesce(F.sum(F.length("reply").cast("bigint")), F.lit(0).cast("bigint")).alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.sum("chars").alias("formatted_chars"),
        F.count("*").alias("n_examples"),
    )
