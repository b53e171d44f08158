"""Chat formatting in DataFrame functions only.

Turn structs are collected and sorted, adjacent turns of one role are merged by array
aggregation, and the pieces are concatenated.  The template is reversible: control strings
all begin with "<|" and a text's own "\\" and "<|" are escaped, so no text can open or close
a turn, and reading back splits at control strings alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.shared import let

#: Opens a block: OPEN role BODY text (NEXT text)* CLOSE.
OPEN, BODY, NEXT, CLOSE = "<|turn|>", "<|says|>", "<|more|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    learn_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: conv_id, formatted (string), loss_spans (array of start, length).

    Spans count code points from 0 and cover each `learn_role` text, escaped, without control
    strings.  Turns sort by turn number (null first), then role, then text, so ties and
    repeated rows give one result.  Null roles and texts are empty.  Rows with a null
    conversation id form one conversation.  Further columns are ignored.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        escape(F.coalesce(F.col(role_col), F.lit(""))).alias("role"),
        escape(F.coalesce(F.col(text_col), F.lit(""))).alias("text"),
    )
    def opens(turns: Column) -> Column:
        """Where a turn's role differs from the one before; a block reaches to the next opening."""
        return F.filter(
            F.sequence(F.lit(0), F.size(turns) - 1),
            lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, F.greatest(i - 1, F.lit(0)))["role"]),
        )

    def blocks(turns: Column, starts: Column) -> Column:
        """Array of (role, texts): adjacent turns of one role merged."""

        def block(start: Column, i: Column) -> Column:
            end = F.coalesce(F.get(starts, i + 1), F.size(turns))
            texts = F.transform(F.slice(turns, start + 1, end - start), lambda t: t["text"])
            return F.struct(F.get(turns, start)["role"].alias("role"), texts.alias("texts"))

        return F.transform(starts, block)

    def piece(s: Column, learn: Column) -> Column:
        return F.struct(s.alias("s"), learn.alias("learn"), F.length(s).cast("long").alias("n"))

    def pieces(block: Column) -> Column:
        """Control strings and texts in turn; `learn` marks the texts under the loss mask."""
        n = F.size(block["texts"])
        no = F.lit(False)

        def of(text: Column, i: Column) -> Column:
            before = F.when(i == 0, F.concat(F.lit(OPEN), block["role"], F.lit(BODY))).otherwise(F.lit(NEXT))
            after = F.when(i == n - 1, F.lit(CLOSE)).otherwise(F.lit(""))
            return F.array(piece(before, no), piece(text, block["role"] == escape(F.lit(learn_role))), piece(after, no))

        return F.flatten(F.transform(block["texts"], of))

    # Offsets are prefix sums of piece lengths.  Each text and its two control strings are one
    # step of the walk, and the spans are appended for learned texts only.
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def walk(acc: Column, p: Column) -> Column:
        span = F.array(F.struct(acc["at"].alias("start"), p["n"].alias("length")))
        spans = F.when(p["learn"], F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((acc["at"] + p["n"]).alias("at"), spans.alias("spans"))

    def finish(p: Column) -> Column:
        return F.struct(
            F.array_join(F.transform(p, lambda x: x["s"]), "").alias("formatted"),
            F.aggregate(p, start, walk)["spans"].alias("loss_spans"),
        )

    def whole(turns: Column) -> Column:
        flat = let(opens(turns), lambda starts: F.flatten(F.transform(blocks(turns, starts), pieces)))
        return let(flat, finish)

    rows = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.collect_list(turn).alias("turns"))
    done = rows.select("conv_id", let(F.array_sort("turns"), whole).alias("done"))
    return done.select("conv_id", "done.formatted", "done.loss_spans")


def read_chats(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text) as written, and learned (the unescaped text under the mask).

    Reads `formatted` and `loss_spans` alone, so it inverts `format_chats` up to null = empty.
    """
    def turns_of(block: Column) -> Column:
        pair = F.split(F.substr(block, F.lit(len(OPEN) + 1)), r"<\|says\|>", -1)
        return let(
            pair,
            lambda p: F.transform(
                F.split(F.get(p, F.lit(1)), r"<\|more\|>", -1),
                lambda t: F.struct(unescape(F.get(p, F.lit(0))).alias("role"), unescape(t).alias("text")),
            ),
        )

    blocks = F.filter(F.split("formatted", r"<\|end\|>", -1), lambda b: b != "")
    learned = F.array_join(
        F.transform(
            "loss_spans",
            lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))),
        ),
        "",
    )
    return formatted.select("conv_id", F.flatten(F.transform(blocks, turns_of)).alias("turns"), learned.alias("learned"), "formatted")
