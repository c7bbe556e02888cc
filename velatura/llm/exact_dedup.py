"""Exact deduplication by two-pass Bloom filtering (DataFrame operations only).

Pass 1 reads the texts once and reduces them to a Bloom filter: a 64-bit hash of the text picks one
64-bit block and one bit in it; the blocks are built by OR, together with the number of rows that
fell in each. A block that holds fewer bits than rows has met some bit twice, so every repeated text
lies in such a block: there are no false negatives. Those blocks form the second filter, a bitmap.

Pass 2 reads the texts again and asks the bitmap. Rows outside it are unique and go straight through
without a shuffle; only the others are grouped by the SHA-256 of their whole text.

The bitmap takes one bit per block and there is about one block per row, so it is broadcast only up to
``max_blocks`` (2**28 blocks: 32 MB). Beyond that the blocks hold more rows each: more rows shuffle,
the result stays the same. When the number of rows passes 8 rows a block the filter would let nearly all
rows through, so it is left out and all rows are grouped.

Hot texts. Of a text that a third of all rows share each task sends one partial maximum and count; the result is handed back by ``join_hot``.

Defined cases: a null text counts as empty; very long texts are hashed whole and never sent by ``exact_groups``; rows that repeat the doc_id as well as the text are copies
like any other (``exact_groups`` marks each of them kept, ``exact_dedup`` returns one of them); a null
doc_id ranks below any other; an empty table gives an empty result. ``exact_dedup`` returns all input
columns whatever their names; the working columns have a prefix of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot

_BITS = 32768  # bits in one bitmap of bitmap_construct_agg


def _block(hashed: Column, n_blocks: int) -> Column:
    return F.pmod(F.shiftright(hashed, 6), F.lit(n_blocks))


def _repeated_blocks(hashes: DataFrame, n_blocks: int) -> DataFrame:
    """(bucket, bits) bitmaps of the blocks in which some bit was met twice."""
    h = F.col("_ed_hash")
    return (
        hashes.groupBy(_block(h, n_blocks).alias("_ed_block"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(_ed_hash & 63 as int))")).alias("_ed_seen"), F.count(F.lit(1)).alias("_ed_rows"))
        .where(F.bit_count("_ed_seen") < F.col("_ed_rows"))
        .groupBy(F.expr("bitmap_bucket_number(_ed_block + 1)").alias("_ed_bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_ed_block + 1))").alias("_ed_bits"))
    )


def _marked(rows: DataFrame, text: Column, max_blocks: int) -> tuple[DataFrame, int]:
    """``rows`` with ``_ed_maybe``: false only for rows whose text no other row has; and their number."""
    n = rows.count()
    n_blocks = 1 << max(10, min(max_blocks, max(1, n)).bit_length())
    n_blocks = min(n_blocks, 1 << (max_blocks.bit_length() - 1))
    if n > 8 * n_blocks:
        return rows.withColumn("_ed_maybe", F.lit(True)), n
    blocks = _repeated_blocks(rows.select(F.xxhash64(text).alias("_ed_hash")), n_blocks)
    probed = rows.withColumn("_ed_block", _block(F.xxhash64(text), n_blocks) + 1).withColumn("_ed_bucket", F.expr("bitmap_bucket_number(_ed_block)"))
    # at most n_blocks / 32768 bitmaps of 4 KB: 32 MB under the default bound
    probed = probed.join(F.broadcast(blocks), "_ed_bucket", "left")
    byte = F.expr("cast(conv(hex(substring(_ed_bits, cast(bitmap_bit_position(_ed_block) div 8 as int) + 1, 1)), 16, 10) as int)")
    bit = F.expr("cast(bitmap_bit_position(_ed_block) % 8 as int)")
    hit = F.col("_ed_bits").isNotNull() & (F.coalesce(byte, F.lit(0)).bitwiseAND(F.call_function("shiftleft", F.lit(1), bit)) != 0)
    return probed.withColumn("_ed_maybe", hit).drop("_ed_bucket", "_ed_block", "_ed_bits"), n


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_blocks: int = 1 << 28) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row."""
    text = F.coalesce(F.col("_ed_text"), F.lit(""))
    rows, n = _marked(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_ed_text")), text, max_blocks)
    rows = rows.select("doc_id", "_ed_maybe", F.sha2(text.cast("binary"), 256).alias("text_sha256"))
    alone = rows.where(~F.col("_ed_maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    maybe = rows.where("_ed_maybe").select("doc_id", "text_sha256")
    groups = maybe.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    joined = join_hot(maybe, groups, "text_sha256", "group_size", n, F.col("doc_id")).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return alone.unionByName(joined)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_blocks: int = 1 << 28) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: of equal texts the one with the largest id."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows, _ = _marked(docs, text, max_blocks)
    alone = rows.where(~F.col("_ed_maybe")).select(*docs.columns)
    maybe = rows.where("_ed_maybe").withColumn("_ed_sha", F.sha2(text.cast("binary"), 256))
    groups = maybe.groupBy("_ed_sha").agg(F.max(id_col).alias("_ed_keep"))
    # joined by text and id, so a text that a third of all rows share is spread
    best = maybe.join(groups.withColumnRenamed("_ed_sha", "_ed_key"), (F.col("_ed_sha") == F.col("_ed_key")) & F.col(id_col).eqNullSafe(F.col("_ed_keep")))
    # only rows that share doc_id and text are still more than one
    return alone.unionByName(best.dropDuplicates(["_ed_sha"]).select(*docs.columns))
