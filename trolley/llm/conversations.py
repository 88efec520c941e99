"""Chat formatting after a collapse of cumulative snapshots.

A logged conversation whose turns are the first turns of a longer one, or the same turns as another one, adds nothing. Every turn
gets the hash of the conversation up to it: a running exclusive-or of hashes of (place, role, text), 128 bits in all. A
conversation goes if its last hash is another one's hash at the same place before that one's end (an anti-join on distinct hashes); of
conversations with equal turns the smallest id stays. What is maximal is rendered.

A conversation may hold a third of all rows: places come from a global order, running hashes from chunks of ``CHUNK``
turns and a window over the chunks' totals, and the result has one row per ``part_turns`` turns, so no text is unbounded.

Defined results: turns are ordered by turn, role, text, nulls first; repeated rows are turns of their own. A null role or text
counts as empty. Rows without conv_id are one conversation. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import numbered
from trolley.session import stage

CHUNK = 4096


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Per turn: conv_id, place (from 1), n_turns of its conversation, a and b (hash up to here), role, text."""
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = numbered(rows.withColumn("h", F.xxhash64("role", "text")), ["conv_id", "turn", "role", "h", "text"], "turns").drop("h")
    bounds = rows.groupBy("conv_id").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n_turns"))
    bounds = bounds.withColumnRenamed("conv_id", "id")
    rows = rows.join(bounds, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id")
    rows = rows.withColumn("place", F.col("at") - F.col("first") + 1).drop("at", "first")
    rows = rows.withColumns({
        "a": F.xxhash64(F.lit(1), "place", "role", "text"), "b": F.xxhash64(F.lit(2), "place", "role", "text"),
        "chunk": F.expr(f"(place - 1) div {CHUNK}")})
    totals = rows.groupBy("conv_id", "chunk").agg(F.bit_xor("a").alias("ca"), F.bit_xor("b").alias("cb"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("conv_id").alias("id"), F.col("chunk").alias("own"), *(F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(c) for c in ("ca", "cb")))
    own = Window.partitionBy("conv_id", "chunk").orderBy("place")
    rows = rows.withColumns({c: F.bit_xor(c).over(own) for c in ("a", "b")})
    rows = rows.join(totals, F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("chunk") == F.col("own")))
    return rows.select("conv_id", "place", "n_turns", F.col("a").bitwiseXOR(F.col("ca")).alias("a"),
                       F.col("b").bitwiseXOR(F.col("cb")).alias("b"), "role", "text")


def maximal(hashed: DataFrame) -> DataFrame:
    """conv_id of the conversations that no other one begins with or repeats."""
    ends = (hashed.where(F.col("place") == F.col("n_turns")).groupBy("place", "a", "b")
            .agg(F.min(F.struct(F.col("conv_id").isNotNull(), "conv_id")).alias("c")))
    inner = hashed.where(F.col("place") < F.col("n_turns")).select("place", "a", "b").distinct()
    return ends.join(inner, ["place", "a", "b"], "left_anti").select(F.col("c.conv_id").alias("conv_id"))


def rendered(turns: DataFrame, part_turns: int = 64, opening: str = "<|im_start|>", closing: str = "<|im_end|>") -> DataFrame:
    """Maximal conversations as text: conv_id, part (from 0), n_turns of the part, text; the parts of one, in order, are its text."""
    hashed = stage(prefix_hashes(turns), "turn-prefixes")
    kept = maximal(hashed).withColumnRenamed("conv_id", "kept_id")
    rows = hashed.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")), "left_semi")
    line = F.concat(F.lit(opening), "role", F.lit("\n"), "text", F.lit(closing + "\n"))
    rows = rows.select("conv_id", "place", F.expr(f"cast((place - 1) div {part_turns} as int)").alias("part"), line.alias("line"))
    return rows.groupBy("conv_id", "part").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]), "").alias("text"))
