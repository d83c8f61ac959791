"""Chat formatting after collapsing cumulative snapshots.

Logged conversations often hold a later one's beginning.  Every turn gets a prefix hash: the
running sum, over the turns so far, of four 32-bit lanes of an MD5 of (position, role, text).
A sum can be taken per chunk of turns and carried on, so a conversation of any length is cut
into chunks of ``CHUNK_TURNS`` turn numbers and no window holds a whole one.  A conversation whose
last prefix hash is an inner prefix of some conversation is dropped by an anti-join, and of
equal conversations the one with the smallest id stays; the way to the conversation that
covers it is a join with one pre-aggregated row per prefix.  Only then are the maximal ones
rendered, in parts of at most ``PART_TURNS`` turns, so no string grows without bound.

Defined cases: turns are ordered by (turn, role, text), nulls first; null roles and texts count as
empty text in hashes and in the rendering; repeated rows are repeated turns; rows without a
conversation id form one conversation with a null id and are kept apart from all others; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from autopulse.llm.common import materialise

CHUNK_TURNS = 4096
PART_TURNS = 256
LANES = ["l0", "l1", "l2", "l3"]


def number_turns(turns: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """``pos`` from 0 within each conversation, by chunks of turn numbers."""
    rows = turns.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.floor(F.coalesce(F.col("turn").cast("long"), F.lit(-1)) / chunk_turns).alias("chunk"))
    sizes = rows.groupBy("conv_id", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("chunk")) - F.col("n")
    starts = sizes.select(F.col("conv_id").alias("c_conv"), F.col("chunk").alias("c_chunk"), before.alias("start"))
    local = F.row_number().over(Window.partitionBy("conv_id", "chunk").orderBy(F.asc_nulls_first("turn"), "role", "text"))
    joined = rows.withColumn("local", local).join(
        starts, F.col("conv_id").eqNullSafe(F.col("c_conv")) & (F.col("chunk") == F.col("c_chunk")))
    return joined.select("conv_id", "chunk", "role", "text", (F.col("start") + F.col("local") - 1).alias("pos"))


def _lane(digest: Column, k: int) -> Column:
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def prefix_hashes(numbered: DataFrame) -> DataFrame:
    """``conv_id, pos`` and the four lanes of the hash of the turns up to ``pos``."""
    digest = F.md5(F.concat_ws("\u001f", F.col("pos").cast("string"), F.length("role").cast("string"), "role", "text"))
    rows = numbered.select("conv_id", "chunk", "pos", digest.alias("d")).select(
        "conv_id", "chunk", "pos", *[_lane(F.col("d"), k).alias(c) for k, c in enumerate(LANES)])
    sums = rows.groupBy("conv_id", "chunk").agg(*[F.sum(c).alias(c) for c in LANES])
    over = Window.partitionBy("conv_id").orderBy("chunk")
    carry = sums.select(F.col("conv_id").alias("c_conv"), F.col("chunk").alias("c_chunk"),
                        *[(F.sum(c).over(over) - F.col(c)).alias(f"c_{c}") for c in LANES])
    inner = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("conv_id", "chunk", "pos", *[F.sum(c).over(inner).alias(c) for c in LANES])
    joined = local.join(carry, F.col("conv_id").eqNullSafe(F.col("c_conv")) & (F.col("chunk") == F.col("c_chunk")))
    return joined.select("conv_id", "pos", *[(F.col(c) + F.col(f"c_{c}")).alias(c) for c in LANES])


def collapse(prefixes: DataFrame) -> DataFrame:
    """``conv_id, n_turns, covered_by, kept`` for every conversation."""
    sizes = prefixes.groupBy("conv_id").agg((F.max("pos") + 1).alias("n_turns"))
    rows = prefixes.join(sizes.withColumnRenamed("conv_id", "s_conv"), F.col("conv_id").eqNullSafe(F.col("s_conv")))
    rows = materialise(rows.drop("s_conv").where("conv_id IS NOT NULL"), "chat-prefixes")
    key = ["pos", *LANES]
    ends = rows.where(F.col("pos") == F.col("n_turns") - 1)
    inner = rows.where(F.col("pos") < F.col("n_turns") - 1).select(*key).distinct()
    maximal = ends.join(inner, key, "left_anti").groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    best = rows.groupBy(*key).agg(F.max(F.struct("n_turns", (-F.col("conv_id")).alias("neg"))).alias("b"))
    covered = ends.join(best, key).select("conv_id", "n_turns", (-F.col("b.neg")).alias("covered_by"))
    kept = maximal.select("conv_id", F.lit(True).alias("kept"))
    answer = covered.join(kept, "conv_id", "left").select(
        "conv_id", "n_turns", "covered_by", F.coalesce("kept", F.lit(False)).alias("kept"))
    without_id = sizes.where("conv_id IS NULL").select(
        "conv_id", "n_turns", F.lit(None).cast(answer.schema["covered_by"].dataType).alias("covered_by"),
        F.lit(True).alias("kept"))
    return answer.unionByName(without_id)


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def chat_format(turns: DataFrame, part_turns: int = PART_TURNS, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """``conv_id, n_turns, covered_by, kept, part, rendered``.

    A kept conversation has one row per part of at most ``part_turns`` turns; a dropped one has
    one row with part 0 and rendered NULL.
    """
    numbered = materialise(number_turns(turns, chunk_turns), "chat-turns")
    verdict = materialise(collapse(prefix_hashes(numbered)), "chat-verdict")
    kept = verdict.where("kept").select(F.col("conv_id").alias("k_conv"))
    part = F.floor(F.col("pos") / part_turns).cast("int")
    lines = (numbered.join(kept, F.col("conv_id").eqNullSafe(F.col("k_conv")), "left_semi")
             .select("conv_id", part.alias("part"), "pos", render_turn(F.col("role"), F.col("text")).alias("line"))
             .groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("l"))
             .select(F.col("conv_id").alias("r_conv"), "part", F.array_join(F.col("l.line"), "").alias("rendered")))
    return verdict.join(lines, F.col("conv_id").eqNullSafe(F.col("r_conv")), "left").select(
        "conv_id", "n_turns", "covered_by", "kept", F.coalesce("part", F.lit(0)).alias("part"), "rendered")
