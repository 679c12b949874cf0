"""Preference formatting: a shared prompt, and the two completions with loss masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prefix_sums, written

BEGIN, END = "<|im_start|>", "<|im_end|>"
MARK, BROKEN_MARK = "<|im_", "<| im_"
TRAINED_ROLE = "assistant"
TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation of (conv_id, turn, role, text) as one sorted array.

    A null role is `unknown`, a null text empty, a null turn number stands first, and turns with the
    same number are sorted by role and text.
    """
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def pairs_by_opening(turns: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, chosen, rejected): preference pairs out of plain conversations.

    Conversations with the same first turn stand in the order of their ids; the first is chosen over
    the second, the third over the fourth, and so on. One that is left over is chosen over itself with
    its last assistant turn replaced by an echo of the turn before it; then `rejected_id` is null. Each
    conversation is in one pair. Places are found by a distributed sort, so that an opening which a
    third of the conversations share is no single task's work.
    """
    whole = written(conversations(turns), "preference-conversations")
    opening = F.md5(F.concat_ws("\n", F.col("turns")[0]["role"], F.col("turns")[0]["text"]))
    openings = whole.select("conv_id", opening.alias("opening"), F.lit(1).alias("_one"))
    placed = written(
        prefix_sums(openings, "opening", ["conv_id"], "_one", "preference-order").select(
            F.col("conv_id").alias("_id"),
            "opening",
            F.floor(F.col("row_before") / 2).alias("_pair"),
            (F.col("row_before") % 2).alias("_side"),
        ),
        "preference-places",
    )
    sided = whole.join(placed, F.col("conv_id").eqNullSafe(F.col("_id")))
    side = F.struct("conv_id", "turns")
    paired = sided.groupBy("opening", "_pair").agg(
        F.max(F.when(F.col("_side") == 0, side)).alias("_chosen"),
        F.max(F.when(F.col("_side") == 1, side)).alias("_rejected"),
    )
    return paired.select(
        F.col("_chosen.conv_id").alias("chosen_id"),
        F.col("_rejected.conv_id").alias("rejected_id"),
        F.col("_chosen.turns").alias("chosen"),
        F.coalesce("_rejected.turns", _echoed(F.col("_chosen.turns"))).alias("rejected"),
    )


def _echoed(turns: Column) -> Column:
    places = F.transform(turns, lambda t, i: F.when((t["role"] == TRAINED_ROLE) & (i > 0), i))
    last = F.coalesce(F.array_max(F.array_compact(places)), F.lit(-1))
    return F.transform(
        turns,
        lambda t, i: F.when(
            i == last, F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.get(turns, i - 1)["text"].alias("text"))
        ).otherwise(t),
    )


def shared_turns(chosen: Column, rejected: Column) -> Column:
    """The number of leading turns that agree in role and text."""
    same = F.zip_with(
        chosen, rejected, lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])
        & a.isNotNull() & b.isNotNull()
    )
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def _content(turn: Column) -> Column:
    """The text, in which nothing reads like a mark of the format."""
    return F.replace(turn["text"], F.lit(MARK), F.lit(BROKEN_MARK))


def rendered(turns: Column) -> Column:
    return F.array_join(
        F.transform(
            turns,
            lambda t: F.concat(F.lit(BEGIN), F.replace(t["role"], F.lit(MARK), F.lit(BROKEN_MARK)), F.lit("\n"), _content(t), F.lit(f"{END}\n")),
        ),
        "",
    )


def loss_spans(turns: Column) -> Column:
    """Array of (start, stop), in code points of the rendered turns, of what is trained on.

    That is the content of the assistant's turns with the mark that ends it; all else is masked.
    """
    head = lambda t: F.length(F.replace(t["role"], F.lit(MARK), F.lit(BROKEN_MARK))) + len(BEGIN) + 1
    whole = lambda t: head(t) + F.length(_content(t)) + len(END) + 1
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"))
    return F.aggregate(
        turns,
        start,
        lambda acc, t: F.struct(
            (acc["at"] + whole(t)).alias("at"),
            F.when(
                t["role"] == TRAINED_ROLE,
                F.concat(
                    acc["spans"],
                    F.array(F.struct((acc["at"] + head(t)).alias("start"), (acc["at"] + whole(t) - 1).alias("stop"))),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Adds to each row of (chosen, rejected), arrays of turns, what training on preferences reads.

    `prompt`: the turns that both begin with, rendered once; `chosen_text` and `rejected_text`: what
    follows in each, rendered; `chosen_loss` and `rejected_loss`: the spans of these texts that are
    trained on. `prompt_turns`, `chosen_turns` and `rejected_turns` count turns. Equal conversations
    are all prompt, with empty completions; a null or empty side has no turns. The other columns stay,
    but for those with these names, which are replaced. A conversation is one row, as is a training
    example, so it has to fit into a row.
    """
    none = F.array().cast(TURNS)
    sides = pairs.withColumn("_c", F.coalesce("chosen", none)).withColumn("_r", F.coalesce("rejected", none))
    counted = sides.withColumn("prompt_turns", shared_turns(F.col("_c"), F.col("_r")))
    split = counted.withColumns(
        {
            "_prompt": F.slice("_c", F.lit(1), F.col("prompt_turns")),
            "_c": F.slice("_c", F.col("prompt_turns") + 1, F.size("_c")),
            "_r": F.slice("_r", F.col("prompt_turns") + 1, F.size("_r")),
        }
    )
    return split.withColumns(
        {
            "chosen_turns": F.size("_c"),
            "rejected_turns": F.size("_r"),
            "prompt": rendered(F.col("_prompt")),
            "chosen_text": rendered(F.col("_c")),
            "rejected_text": rendered(F.col("_r")),
            "chosen_loss": loss_spans(F.col("_c")),
            "rejected_loss": loss_spans(F.col("_r")),
        }
    ).drop("_prompt", "_c", "_r")
