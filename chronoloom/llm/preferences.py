"""Preference pairs for training: a shared prompt and two masked completions.

Chosen and rejected conversations are tables of turns. Their longest common prefix of turns is
found by comparing turns of the same number and taking the least number at which they differ, so
no conversation is ever gathered into one row, however long it is. The result has one row for
each rendered turn: the prompt's turns once, then the turns of both completions. Only assistant
turns of completions count for the loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.llm.exchange import written

PROMPT, CHOSEN, REJECTED = "prompt", "chosen", "rejected"


def render(role: Column, text: Column) -> Column:
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def _turns(turns: DataFrame, name: str) -> DataFrame:
    """Turns that share a number are told apart by their place in order of role and text."""
    rows = turns.filter("pair_id is not null and turn is not null")
    order = Window.partitionBy("pair_id", "turn").orderBy("role", "text")
    return rows.select("pair_id", "turn", F.row_number().over(order).alias("nr"), F.struct("role", "text").alias(name))


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, part, turn, rendered, trained) from turns (pair_id, turn, role, text) of both sides.

    Turns are equal if role and text are, nulls included; a null renders as empty. Turns that share
    a number follow each other by role and text. An empty table gives no rows. Turns without
    a pair or number are left out, and so are pairs that are on one side only. If the sides do not
    differ, all is prompt. Columns other than the four are ignored.
    """
    a, b = _turns(chosen, CHOSEN), _turns(rejected, REJECTED)
    both = a.join(b, ["pair_id", "turn", "nr"], "full").withColumn("place", F.struct("turn", "nr"))
    differs = ~F.col(CHOSEN).eqNullSafe(F.col(REJECTED))
    sides = both.groupBy("pair_id").agg(
        F.min(F.when(differs, F.col("place"))).alias("first"),
        F.count(CHOSEN).alias("a"),
        F.count(REJECTED).alias("b"),
    )
    both = both.join(sides.filter("a > 0 and b > 0").select("pair_id", "first"), "pair_id")
    shared = F.col("first").isNull() | (F.col("place") < F.col("first"))
    part = lambda name, side: F.when(F.col(side).isNotNull(), F.struct(F.lit(name).alias("part"), F.col(side).alias("side")))
    parts = F.when(shared, F.array(part(PROMPT, CHOSEN))).otherwise(
        F.array(part(CHOSEN, CHOSEN), part(REJECTED, REJECTED))
    )
    rows = both.select("pair_id", "turn", F.explode(F.array_compact(parts)).alias("x"))
    role, text = F.col("x.side.role"), F.col("x.side.text")
    return rows.select(
        "pair_id",
        F.col("x.part").alias("part"),
        "turn",
        render(role, text).alias("rendered"),
        ((F.col("x.part") != PROMPT) & role.eqNullSafe(F.lit("assistant"))).alias("trained"),
    )


def _answers(t: DataFrame) -> DataFrame:
    """Number and text of each conversation's last assistant turn."""
    last = t.filter("role = 'assistant'").groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    return last.select("pair_id", F.col("last.turn").alias("last"), F.col("last.text").alias("answer"))


def _swapped(t: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the conversations of (pair_id, last, other), and with `other` as their last answer."""
    chosen = t.join(pairs, "pair_id")
    swap = (F.col("turn") == F.col("last")) & (F.col("role") == "assistant")
    rejected = chosen.withColumn("text", F.when(swap, F.col("other")).otherwise(F.col("text")))
    cols = ["pair_id", "turn", "role", "text"]
    return chosen.select(cols), rejected.select(cols)


def swapped_pairs(turns: DataFrame, conv_col: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns from plain conversations whose ids follow each other without gaps.

    A conversation is chosen over itself with its last assistant turn replaced by that of the
    conversation with the next id; conversations without an assistant turn, or whose next id has
    none, make no pair. `neighbour_pairs` loses none to gaps.
    """
    t = turns.select(F.col(conv_col).alias("pair_id"), "turn", "role", "text")
    last = _answers(t)
    other = last.select((F.col("pair_id") - 1).alias("pair_id"), F.col("answer").alias("other"))
    return _swapped(t, last.join(other, "pair_id").select("pair_id", "last", "other"))


def _next_ids(ids: DataFrame) -> DataFrame:
    """(pair_id, following) of different ids: the next one in order, the least for the greatest.

    Ids are dealt out by ranges, and the least of each range follows the greatest of the one before.
    Only one row for each range comes to the driver.
    """
    ranged = written(ids.repartitionByRange("pair_id").withColumn("part", F.spark_partition_id()), "ranged")
    least = ranged.groupBy("part").agg(F.min("pair_id").alias("pair_id")).orderBy("part").collect()
    parts = [(r.part, least[(i + 1) % len(least)].pair_id) for i, r in enumerate(least)]
    kind = ids.schema["pair_id"].dataType.simpleString()
    after = ids.sparkSession.createDataFrame(parts, f"part int, after {kind}")
    following = F.lead("pair_id").over(Window.partitionBy("part").orderBy("pair_id"))
    x = ranged.withColumn("following", following).join(F.broadcast(after), "part")
    return x.select("pair_id", F.coalesce("following", "after").alias("following"))


def neighbour_pairs(turns: DataFrame, conv_col: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns from plain conversations with ids of any kind that has an order.

    A conversation with an assistant turn is chosen over itself with its last one replaced by that
    of the next such conversation in id order, the first for the last. Without another such
    conversation there is no pair; rows without an id are left out.
    """
    t = turns.select(F.col(conv_col).alias("pair_id"), "turn", "role", "text").filter("pair_id is not null")
    last = _answers(t)
    following = _next_ids(last.select("pair_id")).filter("pair_id <> following")
    other = last.select(F.col("pair_id").alias("following"), F.col("answer").alias("other"))
    pairs = last.join(following, "pair_id").join(other, "following")
    return _swapped(t, pairs.select("pair_id", "last", "other"))
