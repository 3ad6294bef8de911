"""Exact dedup by two-pass Bloom filtering, in DataFrame operations only.

Pass 1 hashes every normalised text and sets ``K`` bits of a blocked counting
Bloom filter: bit numbers are counted (pre-aggregated map-side, a few bytes
per row), and the bits hit at least twice form the *repeat filter*, stored as
bitmaps of ``BLOCK`` bits. Pass 2 probes that filter with every row. A row
that misses one of its bits is certainly unique: it passes straight through
without a shuffle. Only the possibly repeated rows are grouped and joined by
their SHA-256, which also removes the filter's false positives.

The filter takes ``BITS_PER_ROW`` bits per row, so its size is known before it
is built: it is broadcast below ``BROADCAST_BYTES``. Beyond, only fingerprints
(id, hash, length) are joined to it by block number; whole rows then probe a
second filter, of the hashes that proved repeated, which is always broadcast
(``WIDE_FILTER_BYTES`` at most; fewer bits a hash where there are many, so more
unique rows are checked). Groups that hold over a thousandth of the rows (so at most
1,000) are joined through a broadcast, the others through a shuffle in which
no key is hot.

Defined results: a null text counts as empty; empty texts are equal to each
other and to texts of white space only. A null ``doc_id`` sorts after all
others; rows repeating both id and text share one decision. Other input
columns pass through `drop_copies` and are ignored by `decide_copies`. An empty table gives an empty
result. Texts of any length are hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsieve.llm.common import BROADCAST_BYTES, WS, broadcast_if_small, stored

K = 2
BITS_PER_ROW = 16
BLOCK = 32768  # bits of one bitmap of bitmap_construct_agg
WIDE_FILTER_BYTES = 128 << 20  # filter of repeated hashes, probed by whole rows


def normalised(text: Column) -> Column:
    """Text without ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WS + "+", "")


def _bits(sha: Column, blocks: int) -> tuple[Column, list[Column]]:
    """(block, bit numbers within it) of a row."""
    h = F.xxhash64(sha)
    block = F.pmod(h, F.lit(blocks).cast("bigint"))
    return block, [F.pmod(F.xxhash64(sha, F.lit(i)), F.lit(BLOCK).cast("bigint")) for i in range(K)]


def _bit_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (bit % 8 + 1).cast("int"))) != 0


def _blocks(hashes: int) -> int:
    return max(1, -(-hashes * BITS_PER_ROW // BLOCK))


def repeat_filter(shas: DataFrame, blocks: int, least: int = 2) -> DataFrame:
    """Pass 1: ``(block, bitmap)`` of the bits that at least ``least`` rows set."""
    block, bits = _bits(F.col("sha"), blocks)
    return (
        shas.select(F.explode(F.array_distinct(F.array(*[block * BLOCK + b for b in bits]))).alias("bit"))
        .groupBy("bit").count().where(F.col("count") >= least)
        .groupBy(F.floor(F.col("bit") / BLOCK).alias("block"))
        .agg(F.expr(f"bitmap_construct_agg(bit % {BLOCK})").alias("bitmap"))
    )


def _maybe(rows: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """Pass 2: add ``__maybe``, true where the repeat filter has all bits of a row."""
    block, bits = _bits(F.col("text_sha256"), blocks)
    side = bloom.select(F.col("block").alias("__block"), F.col("bitmap").alias("__bitmap"))
    hit = F.lit(True)
    for b in bits:
        hit = hit & _bit_set(F.col("__bitmap"), b)
    return (
        rows.withColumn("__block", block).join(side, "__block", "left")
        .withColumn("__maybe", F.coalesce(hit, F.lit(False))).drop("__block", "__bitmap")
    )


def _build(docs: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """(fingerprints, repeat filter, its blocks, rows); both tables are stored."""
    prints = stored(docs.select("doc_id", _sha(), F.length(F.coalesce(F.col("text"), F.lit(""))).alias("size")), "prints")
    n = prints.count()
    blocks = _blocks(n)
    bloom = stored(repeat_filter(prints.select(F.col("text_sha256").alias("sha")), blocks), "bloom")
    return prints, F.broadcast(bloom) if _fits(blocks) else bloom, blocks, n


def _fits(blocks: int) -> bool:
    return blocks * BLOCK // 8 <= BROADCAST_BYTES


def _copied_filter(groups: DataFrame) -> tuple[DataFrame, int]:
    """(filter of the hashes that several rows have, its blocks), broadcast at any number of hashes."""
    copied = groups.where("group_size > 1").select(F.col("text_sha256").alias("sha"))
    blocks = max(1, min(_blocks(copied.count()), WIDE_FILTER_BYTES * 8 // BLOCK))
    return F.broadcast(stored(repeat_filter(copied, blocks, least=1), "copied")), blocks


def _sha() -> Column:
    return F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256).alias("text_sha256")


def _decide(prints: DataFrame, bloom: DataFrame, blocks: int, n: int) -> tuple[DataFrame, DataFrame]:
    """(decision of every row, groups of the possibly repeated hashes)."""
    probed = _maybe(prints, bloom, blocks)
    maybe = probed.where("__maybe").drop("__maybe")
    groups = stored(
        maybe.groupBy("text_sha256").agg(
            F.count(F.lit(1)).alias("group_size"),
            # most code points, then smallest id (null id last); ~id reverses the order
            F.max(F.struct("size", F.col("doc_id").isNotNull().alias("has"), F.bitwise_not(F.col("doc_id")).alias("neg"))).alias("best"),
        ).select("text_sha256", "group_size", F.bitwise_not(F.col("best.neg")).alias("keep_id")),
        "groups",
    )
    hot = max(1000, n // 1000)
    heavy = groups.where(F.col("group_size") > hot)
    n_heavy = heavy.count()
    if n_heavy:
        # at most 1,000 groups hold over a thousandth of the rows each
        keys = broadcast_if_small(heavy.select("text_sha256"), n_heavy, 100)
        light = maybe.join(keys, "text_sha256", "left_anti").join(groups.where(F.col("group_size") <= hot), "text_sha256")
        repeated = light.unionByName(maybe.join(broadcast_if_small(heavy, n_heavy, 200), "text_sha256"))
    else:
        repeated = maybe.join(groups, "text_sha256")
    single = probed.where(~F.col("__maybe")).drop("__maybe") \
        .withColumns({"group_size": F.lit(1).cast("bigint"), "keep_id": F.col("doc_id")})
    decided = single.unionByName(repeated) \
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return decided, groups


def decide_copies(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the most code points, then the smallest id
    stays. Texts are read and hashed once; what follows works on fingerprints.
    """
    return _decide(*_build(docs))[0]


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns. Rows that the filter proves
    unique never shuffle; of rows that repeat id and text one stays. (Above
    ``WIDE_FILTER_BYTES * 8 / BITS_PER_ROW`` repeated hashes, 67 million, the
    filter proves less: about 60 % of the unique rows at 537 million.)"""
    prints, bloom, blocks, n = _build(docs)
    decided, groups = _decide(prints, bloom, blocks, n)
    if not _fits(blocks):  # too large to be sent to whole rows
        bloom, blocks = _copied_filter(groups)
    rows = docs.select(F.struct("*").alias("__row"), "doc_id", _sha())
    probed = _maybe(rows, bloom, blocks)
    maybe = probed.where("__maybe")
    dropped = stored(decided.where("not kept").select("doc_id", "text_sha256").distinct(), "dropped")
    key = [maybe["doc_id"].eqNullSafe(dropped["doc_id"]), maybe["text_sha256"] == dropped["text_sha256"]]
    stay = maybe.join(dropped, key, "left_anti").dropDuplicates(["doc_id", "text_sha256"])
    return probed.where(~F.col("__maybe")).select("__row.*").unionByName(stay.select("__row.*"))
