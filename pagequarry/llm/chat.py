"""Chat formatting after a collapse of cumulative snapshots, with DataFrame
functions only.

A log often holds a conversation again each time it grew. The turns of a
conversation are numbered and every prefix gets a rolling hash: two 64-bit
hashes of (place, role, text), summed up to each turn as four 32-bit lanes. A
conversation whose whole is a proper prefix of another is dropped by an
anti-join of its end with the distinct prefixes, equal ones are kept once (the
smallest conv_id), and the maximal ones are rendered.

Places and hashes are prefix sums on two levels, ranges of ``RANGE`` turn
numbers and the turns within one, so a conversation with a third of all rows is
not one task's; a rendered conversation comes in segments of ``SEGMENT`` turns,
one rule for all of them. A first turn that many share is one distinct prefix,
combined before it is shuffled.

Cases: rows alike in all four columns count once; turns with one number are
ordered by role and text, those without a number come first; null roles and
texts are empty; a null conv_id is a conversation; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.llm.common import stage

RANGE = 1024
SEGMENT = 32
LANES = ("h1", "h2", "h3", "h4")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, role, text, range, place, h1..h4)``: each distinct turn, its
    place from 1 and the lanes of the hash of all turns up to it."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).distinct()
    turns = stage(turns.withColumn("range", F.floor(F.col("turn") / F.lit(RANGE))), "turns")
    inside = Window.partitionBy("conv_id", "range").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = Window.partitionBy("conv_id").orderBy(F.col("range").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    counts = turns.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("conv_id", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = _by_range(turns.withColumn("at", F.row_number().over(inside)), counts).withColumn("place", F.col("base") + F.col("at")).drop("base", "at")
    one, two = F.xxhash64("place", "role", "text"), F.xxhash64(F.lit("second"), "text", "role", "place")
    low = F.lit(0xFFFFFFFF)
    terms = [one.bitwiseAND(low), F.shiftrightunsigned(one, 32), two.bitwiseAND(low), F.shiftrightunsigned(two, 32)]
    hashed = placed.withColumns(dict(zip(LANES, terms)))
    upto = Window.partitionBy("conv_id", "range").orderBy("place")
    sums = hashed.groupBy("conv_id", "range").agg(*(F.sum(x).alias(x) for x in LANES))
    sums = sums.select("conv_id", "range", *(F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"base_{x}") for x in LANES))
    rolled = _by_range(hashed.withColumns({x: F.sum(x).over(upto) for x in LANES}), sums)
    return rolled.withColumns({x: F.col(x) + F.col(f"base_{x}") for x in LANES}).select("conv_id", "role", "text", "range", "place", *LANES)


def _by_range(turns: DataFrame, ranges: DataFrame) -> DataFrame:
    named = ranges.withColumnsRenamed({"conv_id": "_conv", "range": "_range"}).hint("merge")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("range").eqNullSafe(F.col("_range"))
    return turns.join(named, same).drop("_conv", "_range")


def maximal(turns: DataFrame) -> DataFrame:
    """``(conv_id, turns)`` of the conversations to keep, of numbered turns."""
    ends = turns.groupBy("conv_id").agg(F.max(F.struct("place", *LANES)).alias("end")).select("conv_id", "end.*")
    # The smallest conv_id of equal conversations; a null one only if alone.
    ends = ends.groupBy("place", *LANES).agg(F.min("conv_id").alias("conv_id"))
    whole = turns.groupBy("conv_id").agg(F.max("place").alias("_last"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    prefixes = turns.select("conv_id", "place", *LANES).join(whole.withColumnRenamed("conv_id", "_conv").hint("merge"), same).where("place < _last")
    prefixes = prefixes.select("place", *LANES).distinct()
    kept = ends.join(prefixes.hint("merge"), ["place", *LANES], "left_anti")
    return kept.select("conv_id", F.col("place").alias("turns"))


def rendered(role: str = "role", text: str = "text"):
    """A turn between its marks; marks inside a text are taken apart."""
    safe = lambda c: F.replace(F.replace(F.col(c), F.lit("<|im_start|>"), F.lit("<| im_start |>")), F.lit("<|im_end|>"), F.lit("<| im_end |>"))
    return F.concat(F.lit("<|im_start|>"), safe(role), F.lit("\n"), safe(text), F.lit("<|im_end|>\n"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns, segment, text)``: maximal conversations, rendered; the
    texts of a conversation's segments in order are its whole."""
    turns = stage(numbered_turns(conversations), "numbered")
    kept = maximal(turns).withColumnRenamed("conv_id", "_conv").hint("merge")
    chosen = turns.join(kept, F.col("conv_id").eqNullSafe(F.col("_conv")))
    parts = chosen.select("conv_id", "turns", F.floor((F.col("place") - 1) / F.lit(SEGMENT)).alias("segment"), F.struct("place", rendered().alias("text")).alias("part"))
    grouped = parts.groupBy("conv_id", "turns", "segment").agg(F.array_sort(F.collect_list("part")).alias("parts"))  # SEGMENT at most
    return grouped.select("conv_id", "turns", "segment", F.array_join("parts.text", "").alias("text"))
