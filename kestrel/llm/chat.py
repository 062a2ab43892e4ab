"""Chat formatting: keep maximal logged conversations, then render them.

A chat service often logs the whole conversation again after every turn, so a
log holds many snapshots that are prefixes of longer conversations.  Every
turn is reduced to two 64-bit hashes; the hash of a prefix is the XOR of the
position-salted hashes of its turns, so one running window gives all prefix
hashes.  A conversation whose (length, hash) is a proper prefix of another one
is dropped by an anti-join; equal conversations keep the smallest id.  The
texts move only for the conversations that stay.

DataFrame functions only.  A conversation becomes one output row, so its
distinct turns fit one task by definition; rows that repeat a turn are combined
in the task that reads them, before they are shuffled, and again where they
meet, so a turn logged a million times is held once.

Defined results: turns are ordered by ``turn`` (null last), then role, then the
MD5 of the text (nulls first); a row repeated in full counts once; rows without ``conv_id`` belong
to no conversation and are left out; a null role renders as ``unknown``, a
null text as empty; other columns are ignored; empty input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.scratch import written


def _turns(conversations: DataFrame) -> DataFrame:
    content = [F.col("role").isNull(), "role", F.col("text").isNull(), "text"]
    return conversations.select("conv_id", "turn", "role", "text").where("conv_id is not null").withColumns({
        "__h": F.xxhash64(F.lit(17), *content), "__g": F.xxhash64(F.lit(29), *content), "__m": F.md5("text")})


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """(conv_id, n, h, g, last): the hash of each conversation's first n turns."""
    slim = _turns(conversations).select("conv_id", "turn", "role", "__m", "__h", "__g").distinct()
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "__m")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    return (slim.withColumns({"n": F.row_number().over(order), "last": F.lead("__h").over(order).isNull()})
            .withColumns({"h": F.bit_xor(F.xxhash64("n", "__h")).over(upto),
                          "g": F.bit_xor(F.xxhash64("n", "__g")).over(upto)})
            .select("conv_id", "n", "h", "g", "last"))


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies): conversations that are no proper prefix of
    another one; of equal ones the smallest id, with their number."""
    prefixes = written(prefix_hashes(conversations), "prefixes")
    ends = (prefixes.where("last").groupBy("n", "h", "g")
            .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies")))
    inner = prefixes.where("not last").select("n", "h", "g").distinct()
    return (ends.join(inner, ["n", "h", "g"], "left_anti")
            .select("conv_id", F.col("n").cast("long").alias("n_turns"), "n_copies"))


def format_chats(conversations: DataFrame, opening: str = "<|", closing: str = "|>\n",
                 ending: str = "\n") -> DataFrame:
    """(conv_id, n_turns, n_copies, text): each maximal conversation as one
    text, every turn as ``opening role closing text ending``."""
    kept = written(maximal_conversations(conversations), "maximal")
    turn = F.struct(F.col("turn").isNull().alias("late"), "turn", "role", "__m", "text")
    body = F.transform(
        F.sort_array("__turns"),
        lambda t: F.concat(F.lit(opening), F.coalesce(t["role"], F.lit("unknown")), F.lit(closing),
                           F.coalesce(t["text"], F.lit("")), F.lit(ending)))
    return (_turns(conversations).join(kept, "conv_id")
            .groupBy("conv_id", "n_turns", "n_copies").agg(F.collect_set(turn).alias("__turns"))
            .select("conv_id", "n_turns", "n_copies", F.array_join(body, "").alias("text")))
