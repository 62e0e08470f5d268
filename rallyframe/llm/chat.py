"""Chat formatting with collapse of cumulative snapshots.

A logged conversation that is a prefix of a longer one is dropped, and of equal ones the smallest id stays.  Each turn gets
two 64-bit hashes of (turn, role, text); their running exclusive-or over a conversation identifies its prefixes.  An anti
join of whole conversations with the distinct proper prefixes of all leaves the maximal ones, which are rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column

#: Turn numbers in one block of the running hashes and lengths: no group of them holds more steps than that.
SPAN = 64
#: Characters of a rendered part; a conversation of fewer is rendered whole.
PART = 1 << 24


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text), repeats included; null roles and texts are empty, a null turn is -1; null conv_ids take no part."""
    c = conversations
    return c.select(
        column(c, "conv_id").alias("conv_id"),
        F.coalesce(column(c, "turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(column(c, "role"), F.lit("")).alias("role"),
        F.coalesce(column(c, "text"), F.lit("")).alias("text"),
    ).where("conv_id is not null")


def prefixes(steps: DataFrame) -> DataFrame:
    """(conv_id, turn, p1, p2, whole): the hashes of each prefix, and whether it is all of the conversation; no texts travel."""
    hashed = steps.select("conv_id", "turn", *(F.xxhash64(F.lit(k), "turn", "role", "text").alias(f"h{k}") for k in (1, 2))).distinct()
    # turns with one number are one step
    hashed = hashed.groupBy("conv_id", "turn").agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")).withColumn("block", F.floor(F.col("turn") / SPAN))
    blocks = hashed.groupBy("conv_id", "block").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("conv_id").orderBy("block").rowsBetween(1, 1)
    blocks = blocks.select("conv_id", "block", *(F.coalesce(F.expr(f"bit_xor(b{k})").over(earlier), F.lit(0)).alias(f"c{k}") for k in (1, 2)), F.first("block").over(later).isNull().alias("last_block"))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return hashed.join(blocks, ["conv_id", "block"]).select(
        "conv_id",
        "turn",
        *(F.expr(f"bit_xor(h{k})").over(upto).bitwiseXOR(F.col(f"c{k}")).alias(f"p{k}") for k in (1, 2)),
        (F.col("last_block") & F.lead("turn").over(inside).isNull()).alias("whole"),
    )


def maximal(steps: DataFrame) -> DataFrame:
    """(conv_id, copies): conversations that are no proper prefix of another; the smallest id of equal ones, and how many they are."""
    found = prefixes(steps)
    whole = found.where("whole").groupBy("p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    proper = found.where("not whole").select("p1", "p2").distinct()
    return whole.join(proper, ["p1", "p2"], "left_anti").select("conv_id", "copies")


def _begins(lines: DataFrame) -> DataFrame:
    """``lines`` with ``part``: the characters of the conversation before each line, over ``PART``.

    Sums go inside blocks of turn numbers first, then over the blocks of a conversation.
    """
    lines = lines.withColumn("size", F.char_length("line").cast("long")).withColumn("block", F.floor(F.col("turn") / SPAN))
    blocks = lines.groupBy("conv_id", "block").agg(F.sum("size").alias("total"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return lines.join(blocks, ["conv_id", "block"]).withColumn("part", F.floor(begin / PART))


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, part, copies, n_turns, chat: the maximal conversations as text, one row each.

    A turn is ``<|role|>``, a line break, its text and ``<|end|>`` with a line break; turns with one number are ordered by role
    and text, repeated ones are one, and null roles and texts are empty.  A conversation of more than ``PART`` characters goes on in a
    further row with the next ``part``, cut between turns: one text value cannot hold any length.  Of equal conversations the smallest
    id stays, with the number of ``copies``.  Empty table: no rows.  Other columns may have any names.
    """
    steps = turns(conversations)
    line = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("<|end|>\n"))
    kept = _begins(steps.join(maximal(steps), "conv_id").distinct().withColumn("line", line))
    return (
        kept.groupBy("conv_id", "part", "copies")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "line"))).alias("x"))
        .select("conv_id", "part", "copies", F.size("x").cast("long").alias("n_turns"), F.array_join(F.col("x.line"), "").alias("chat"))
    )


ORACLE = """
WITH t AS (SELECT DISTINCT conv_id, coalesce(turn,-1) turn, coalesce(role,'') role, coalesce(text,'') text FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT *, '<|'||role||'|>'||chr(10)||text||'<|end|>'||chr(10) line FROM t),
s AS (SELECT conv_id, turn, string_agg(line, '' ORDER BY role, text) line FROM l GROUP BY 1,2),
p AS (SELECT conv_id, turn, string_agg(turn||':'||line, '') OVER w AS prefix, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC)=1 whole FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)),
f AS (SELECT prefix, min(conv_id) conv_id, count(*) copies FROM p WHERE whole GROUP BY 1),
m AS (SELECT conv_id, copies FROM f WHERE prefix NOT IN (SELECT prefix FROM p WHERE NOT whole)),
b AS (SELECT l.*, copies, CAST(floor(coalesce(sum(length(line)) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0)/16777216.0) AS BIGINT) part FROM l JOIN m USING (conv_id))
SELECT conv_id, part, copies, count(*) n_turns, string_agg(line, '' ORDER BY turn, role, text) chat FROM b GROUP BY 1,2,3
"""
