"""Preference formatting: the shared turns of two conversations once as prompt, the rest as two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def gather_turns(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation with its turns in order, as an array of (role, text).

    A missing role is ``unknown``, a missing text empty; turns without a number come first; equal numbers go by role,
    then text. Rows without a conversation id belong to none and are left out.
    """
    item = F.struct(F.coalesce("turn", F.lit(-1)).alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (turns.where(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("turns"))
            .select(key, F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")))


def reused_reply(turns: Column) -> Column:
    """A worse twin of a conversation: its last reply is replaced by its first one; with one reply only, it has none."""
    places = F.filter(F.transform(turns, lambda t, i: F.when(t["role"] == TRAINED_ROLE, i)), lambda i: i.isNotNull())
    first, last = F.array_min(places), F.array_max(places)
    stale = F.array(F.struct(F.lit(TRAINED_ROLE).alias("role"), F.get(turns, first)["text"].alias("text")))
    return F.when(last.isNull(), turns).when(first == last, F.slice(turns, F.lit(1), last)).otherwise(F.concat(F.slice(turns, F.lit(1), last), stale))


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns that are equal in role and text."""
    n = F.least(F.size(a), F.size(b))
    differs = F.array_position(F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs == 0, n.cast("long")).otherwise(differs - 1)


def _segments(turns: Column) -> Column:
    """Head and body of each turn; bodies of the trained role count for the loss."""
    pairs = F.transform(turns, lambda t: F.array(
        F.struct(F.concat(F.lit(TURN_START), t["role"], F.lit("\n")).alias("text"), F.lit(False).alias("trained")),
        F.struct(F.concat(t["text"], F.lit(TURN_END)).alias("text"), (t["role"] == TRAINED_ROLE).alias("trained"))))
    return F.flatten(pairs)


def format_preferences(pairs: DataFrame, key: str) -> DataFrame:
    """Two rows per pair, ``side`` ``chosen`` and ``rejected``, with the same ``prompt``.

    ``pairs`` has ``key`` and the turns ``chosen`` and ``rejected`` as arrays of (role, text); a missing array is an
    empty one. ``mask`` lists the lengths of the completion's runs in code points, each with ``t`` (counts for the loss)
    or ``m`` (masked): heads and other roles are masked, the trained role's texts and end marks count. Of equal conversations both completions are
    empty; so is the one whose turns are a prefix of the other's. Other columns are dropped.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    sides = pairs.select(key, F.coalesce("chosen", none).alias("chosen"), F.coalesce("rejected", none).alias("rejected"))
    counted = sides.withColumn("common", common_turns(F.col("chosen"), F.col("rejected")))
    cut = F.col("common").cast("int")
    rest = lambda side: F.slice(side, cut + 1, F.size(side))
    rows = counted.select(key, "common", _segments(F.slice("chosen", F.lit(1), cut)).alias("prompt"), F.explode(F.array(
        F.struct(F.lit("chosen").alias("side"), _segments(rest(F.col("chosen"))).alias("segments")),
        F.struct(F.lit("rejected").alias("side"), _segments(rest(F.col("rejected"))).alias("segments")))).alias("row"))
    text = lambda segments: F.array_join(F.transform(segments, lambda s: s["text"]), "")
    run = lambda s: F.concat(F.char_length(s["text"]).cast("string"), F.when(s["trained"], "t").otherwise("m"))
    return rows.select(
        key, F.col("row.side").alias("side"), F.col("common").alias("n_common_turns"), text(F.col("prompt")).alias("prompt"),
        text(F.col("row.segments")).alias("completion"), F.array_join(F.transform("row.segments", run), ",").alias("mask"))
