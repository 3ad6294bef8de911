"""Chat formatting with cumulative-snapshot collapse, in DataFrame operations.

Chat logs often hold a conversation once per turn: each log repeats the one
before and adds a turn. Every turn gets a rolling hash of its conversation up
to it: the running sum of position-salted 64-bit hashes, in four 32-bit
strands, so 128 bits in all. A conversation whose whole hash occurs as the
hash of a longer conversation's prefix is a snapshot of that one, and an
anti-join drops it. Of equal conversations the smallest id stays. The
remaining, maximal conversations are rendered.

Turns are ranked and summed in blocks of ``BLOCK`` turn numbers first, then
block totals along the conversation, so no task holds a whole conversation.
Where null or repeated turn numbers fill a block with over ``HEAVY`` times
``BLOCK`` rows, its rows are counted per distinct turn, dealt by ranges of
(turn, role, text) and cut at every ``BLOCK`` rows, copies included; only
different texts that agree in their first ``KEY_CHARS`` characters stay in one
range.
Prefix hashes are made distinct before they are joined, so a first turn that a
third of all conversations share is one row. Rendered text comes in parts of
``BLOCK`` turns.

Defined results: null role or text counts as empty. Turns are ordered by turn
(null first), then role, then text; what counts is this order, not the turn
numbers. Repeated rows are turns of their own. Turns without conversation id
belong to none and are left out. ``<|`` inside role or text is written
``<\\|``, so no text can imitate the template's marks. Other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adsieve.llm.common import broadcast_if_small, partitions_for, stored

BLOCK = 1024
HEAVY = 16  # blocks' worth of rows in one block of turn numbers
RANGE_ROWS = 100_000
KEY_CHARS = 256
STRANDS = ["a", "b", "c", "d"]


def render_turn(role: Column, text: Column) -> Column:
    """One turn in the chat template."""
    safe = [F.replace(x, F.lit("<|"), F.lit("<\\|")) for x in (role, text)]
    return F.concat(F.lit("<|im_start|>"), safe[0], F.lit("\n"), safe[1], F.lit("<|im_end|>\n"))


def _cut_heavy(rows: DataFrame) -> DataFrame:
    """``rows`` with ``sub``, the part of a block: 0, or for blocks of many rows
    a number that grows along (turn, role, text)."""
    spark, group = rows.sparkSession, ["conv_id", "block"]
    heavy = stored(rows.groupBy(*group).agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > HEAVY * BLOCK), "heavy")
    n, total = heavy.agg(F.count(F.lit(1)), F.sum("k")).first()
    if not n:
        return rows.withColumn("sub", F.lit(0).cast("long"))
    side = broadcast_if_small(heavy.select(F.col("conv_id").alias("i"), F.col("block").alias("j")), n, 24)
    here = (F.col("conv_id") == F.col("i")) & F.col("block").eqNullSafe(F.col("j"))
    tasks = partitions_for(spark, total, RANGE_ROWS)
    distinct = rows.join(side, here, "left_semi").groupBy(*group, "turn", "role", "text").agg(F.count(F.lit(1)).alias("m"))
    begins = [F.substring(c, 1, KEY_CHARS) for c in ("role", "text")]
    # stored, as another evaluation might draw other range bounds
    dealt = stored(distinct.repartitionByRange(tasks, *group, "turn", *begins).withColumn("range", F.spark_partition_id().cast("long")), "ranges")
    ahead = Window.partitionBy(*group, "range").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("s", F.coalesce(F.sum("m").over(ahead), F.lit(0)))
    first, last = F.floor(F.col("s") / BLOCK), F.floor((F.col("s") + F.col("m") - 1) / BLOCK)
    cut = placed.withColumn("q", F.explode(F.sequence(first, last))).select(
        *rows.columns, (F.col("range") * (1 << 40) + F.col("q")).alias("sub"),
        (F.least(F.col("s") + F.col("m"), (F.col("q") + 1) * BLOCK) - F.greatest(F.col("s"), F.col("q") * BLOCK)).alias("w"))
    copies = cut.repartition(tasks, *group, "sub").withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), F.col("w"))))
    return rows.join(side, here, "left_anti").withColumn("sub", F.lit(0).cast("long")).unionByName(copies.drop("w", "one"))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, n, role, text`` and the strands of the rolling hash up
    to each turn (``n``: turns of the conversation)."""
    rows = _cut_heavy(turns.where("conv_id is not null").select(
        "conv_id", F.floor(F.col("turn") / BLOCK).alias("block"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    piece = ["conv_id", "block", "sub"]
    own = Window.partitionBy(*piece).orderBy("turn", "role", "text")
    along = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("block"), "sub")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    named = [F.col(c).alias(f"of_{c}") for c in piece]
    here = F.col("conv_id").eqNullSafe(F.col("of_conv_id")) & F.col("block").eqNullSafe(F.col("of_block")) & (F.col("sub") == F.col("of_sub"))

    def earlier(pieces: DataFrame, names: list[str]) -> DataFrame:
        return pieces.select(*named, *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}0") for x in names])

    counts = rows.groupBy(*piece).agg(F.count(F.lit(1)).alias("k"))
    counts = counts.withColumn("n", F.sum("k").over(whole)).withColumn("k0", F.coalesce(F.sum("k").over(before), F.lit(0)))
    placed = stored(
        rows.withColumn("r", F.row_number().over(own)).join(counts.select(*named, "n", "k0"), here)
        .select(*piece, (F.col("r") + F.col("k0")).alias("pos"), "n", "role", "text"), "turns")
    salted = placed.withColumn("x", F.xxhash64("pos", "role", "text")).withColumn("y", F.xxhash64(F.lit("y"), "text", "role", "pos"))
    low = F.lit(0xFFFFFFFF)
    strands = salted.select(
        *piece, "pos", "n", "role", "text", F.shiftrightunsigned("x", 32).alias("a"), F.col("x").bitwiseAND(low).alias("b"),
        F.shiftrightunsigned("y", 32).alias("c"), F.col("y").bitwiseAND(low).alias("d"))
    running = Window.partitionBy(*piece).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    sums = earlier(strands.groupBy(*piece).agg(*[F.sum(s).alias(s) for s in STRANDS]), STRANDS)
    rolled = strands.withColumns({s: F.sum(s).over(running) for s in STRANDS})
    return rolled.join(sums, here).select("conv_id", "pos", "n", "role", "text", *[(F.col(s) + F.col(f"{s}0")).alias(s) for s in STRANDS])


def maximal(hashes: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies`` of the conversations that no longer one
    begins with; of equal ones the smallest id, with their number."""
    key = ["pos", *STRANDS]
    logs = hashes.where("pos = n").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    begun = hashes.where("pos < n").select(*key).distinct()
    return logs.join(begun, key, "left_anti").select("conv_id", F.col("pos").alias("n_turns"), "n_copies")


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, part, n_turns, n_copies, text``: maximal conversations of
    ``turns (conv_id, turn, role, text)`` in the chat template."""
    hashes = stored(prefix_hashes(turns), "hashes")
    kept = stored(maximal(hashes), "kept")
    pieces = hashes.select("conv_id", "pos", render_turn(F.col("role"), F.col("text")).alias("piece")).join(kept, "conv_id")
    parts = pieces.groupBy("conv_id", F.floor((F.col("pos") - 1) / BLOCK).alias("part")).agg(
        F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"), F.collect_list(F.struct("pos", "piece")).alias("turns"))
    text = F.array_join(F.transform(F.array_sort("turns"), lambda t: t["piece"]), "")
    return parts.select("conv_id", "part", "n_turns", "n_copies", text.alias("text"))
