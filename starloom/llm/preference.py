"""Preference formatting: the turns that two conversations share become one prompt, the rest a
pair of completions with masks. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, BREAK, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def _numbered(turns: DataFrame) -> DataFrame:
    """Rows of the same turn get numbers, in order of role and text; a null turn comes last."""
    copy = F.row_number().over(Window.partitionBy("pair_id", "turn").orderBy("role", "text"))
    return turns.select("pair_id", "turn", "role", "text").withColumn("copy", copy)


def _header(role: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit(BREAK))


def _joined(part: Column) -> tuple[Column, Column]:
    """The text of a list of turns, and the character spans that are to be learned.

    Of a trained turn its text and closing mark are learned, of others nothing.
    """
    lengths = F.transform(part, lambda t: F.char_length(t.header) + F.char_length(t.body))
    before = F.transform(
        lengths, lambda n, k: F.aggregate(F.slice(lengths, F.lit(1), k), F.lit(0), lambda total, one: total + one)
    )
    spans = F.transform(
        F.filter(F.zip_with(part, before, lambda t, start: F.struct(t.alias("t"), start.alias("start"))), lambda z: z.t.trained),
        lambda z: F.struct(
            (z.start + F.char_length(z.t.header)).alias("first"),
            (z.start + F.char_length(z.t.header) + F.char_length(z.t.body)).alias("last"),
        ),
    )
    return F.array_join(F.transform(part, lambda t: F.concat(t.header, t.body)), ""), spans


def preference_pairs(chosen: DataFrame, rejected: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """One row per pair_id in either table of turns (pair_id, turn, role, text).

    Returns pair_id, n_shared_turns, prompt, chosen, rejected, and for both completions the
    spans (first, last) of characters to be learned; the prompt and all turns of other roles are
    masked. Turns are compared by number, role and text; the shared prefix ends before the first
    turn that differs or that one side lacks. If both sides are equal, all is prompt and both
    completions are empty.

    A null role or text equals a null only, and is rendered as empty. Rows that repeat a turn
    number count as further turns in order of role and text. A null pair_id is a pair as any
    other; a null turn number stands last. Other columns are ignored. Empty tables give an empty
    result. A pair's turns are gathered in one row, as its prompt is one value.
    """
    left = _numbered(chosen).selectExpr("pair_id lp", "turn lt", "copy lc", "role left_role", "text left_text")
    right = _numbered(rejected).selectExpr("pair_id rp", "turn rt", "copy rc", "role right_role", "text right_text")
    both = left.join(right, F.expr("lp <=> rp and lt <=> rt and lc = rc"), "full_outer")
    place = F.struct(F.coalesce("lt", "rt").isNull().alias("last"), F.coalesce("lt", "rt").alias("turn"), F.coalesce("lc", "rc").alias("copy"))
    same = F.expr("lc is not null and rc is not null and left_role <=> right_role and left_text <=> right_text")

    def side(prefix: str, there: str) -> Column:
        return F.when(
            F.col(there).isNotNull(),
            F.struct(
                _header(F.col(f"{prefix}_role")).alias("header"),
                F.concat(F.coalesce(f"{prefix}_text", F.lit("")), F.lit(CLOSE)).alias("body"),
                F.coalesce(F.col(f"{prefix}_role") == trained_role, F.lit(False)).alias("trained"),
            ),
        )

    turns = both.select(
        F.coalesce("lp", "rp").alias("pair_id"),
        F.struct(place.alias("place"), same.alias("same"), side("left", "lc").alias("left"), side("right", "rc").alias("right")).alias("t"),
    )
    gathered = turns.groupBy("pair_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    differing = F.filter(F.transform("turns", lambda t, k: F.when(~t.same, k)), lambda k: k.isNotNull())
    cut = gathered.withColumn("n_shared_turns", F.coalesce(F.array_min(differing), F.size("turns")))
    shared = F.slice("turns", F.lit(1), F.col("n_shared_turns"))
    rest = F.slice("turns", F.col("n_shared_turns") + 1, F.size("turns"))
    parts = cut.select(
        "pair_id",
        "n_shared_turns",
        F.transform(shared, lambda t: t.left).alias("p"),
        F.filter(F.transform(rest, lambda t: t.left), lambda t: t.isNotNull()).alias("c"),
        F.filter(F.transform(rest, lambda t: t.right), lambda t: t.isNotNull()).alias("r"),
    )
    (prompt, _), (good, good_spans), (bad, bad_spans) = (_joined(F.col(c)) for c in "pcr")
    return parts.select(
        "pair_id", "n_shared_turns", prompt.alias("prompt"), good.alias("chosen"), good_spans.alias("chosen_spans"),
        bad.alias("rejected"), bad_spans.alias("rejected_spans"),
    )


def neighbour_replies(conversations: DataFrame, trained_role: str = TRAINED_ROLE) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns made from a table of conversations (conv_id, turn, role, text).

    A conversation up to its last reply is chosen; the same with that reply taken from the
    conversation next to it (the id with its last bit changed) is rejected. Without such a
    neighbour the rejected side ends before the reply. Conversations without a reply or an id
    make no pair; of several replies of the same last turn the first in text order counts.
    """
    rows = conversations.select("conv_id", "turn", "role", "text").where("conv_id is not null and turn is not null")
    replies = rows.where(F.col("role") == trained_role)
    last = replies.groupBy("conv_id").agg(F.max(F.struct("turn")).alias("at"))
    final = replies.join(last, "conv_id").where(F.col("turn") == F.col("at.turn")).groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    ends = final.withColumnRenamed("turn", "end_turn")
    before = rows.join(ends.select("conv_id", "end_turn"), "conv_id").where(F.col("turn") < F.col("end_turn"))
    before = before.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    own = ends.select(F.col("conv_id").alias("pair_id"), F.col("end_turn").alias("turn"), F.lit(trained_role).alias("role"), "text")
    other = final.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("pair_id"), "text")
    borrowed = own.drop("text").join(other, "pair_id")
    return before.unionByName(own), before.unionByName(borrowed)


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s.first.cast("string"), s.last.cast("string"))), ",")
