"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame operations only).

Targets. Sources in code-point order (null last) get weights 3, 1, 2, repeating, and share
``share`` times all words by weight. No source may pass ``cap`` times its own words; what is
above is shared again among the others by weight, until none is above. With the sources
sorted by cap / weight this has a closed form: the first k are capped and the others get
one common rate, (total - sum of the first k caps) / (sum of the other weights).

Blocks. The documents of each source are put in a shuffled order (a hash of the id) and their words are cut into blocks of equal
size (within one word): about ``block_words`` each, but no fewer than ``least`` blocks to a source that has the words.

Schedule. Slot i of the mix draws from the source in whose stretch of the cumulative quotas (target in blocks of the source) the
golden-ratio point frac(i * 0.618...) falls. The slot's rank among the slots of its source names the block it takes,
wrapping round after the last. The points alone decide how many slots a source gets: they are so evenly spread that any run of slots, and so the
whole mix, holds each source at its weight to within a few blocks, less than a hundredth of any source of ``least`` blocks. A slot whose
source has no take left (a rank past ``cap`` times its blocks) draws nothing, so no document is taken more than ``cap`` times.

Order. ``first_slot`` of a document is the first slot that takes a word of it; ``mix`` returns its rows in the order of the slots they are drawn at.

Scale. Only (id, source, size) leave the text for the plan. Ranks and offsets are prefix sums in two levels (within
hash buckets or runs of slots, then over their totals), so that a hot source is spread over all tasks. What ``mix`` returns is joined and dealt by row and slot, which have no hot keys.

Defined cases: a null text has no words; documents without words take no part in blocks, have taken 0 and no slot;
rows that repeat an id are laid out and taken each on its own, being told apart by a row number; ties in the shuffled order go by id and row; very long texts
span many blocks; a table without words has target and taken 0; an empty table gives an empty result; extra columns are kept by ``mix`` whatever their names and not read by ``mix_plan``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, checkpointed, small_side

WEIGHTS = (3, 1, 2)
GOLDEN = 0.6180339887498949
_RUN = 4096  # slots in a run, hash buckets of a source
_GRID = 1024  # cells of the grid in which points find their source
LEAST = 512  # blocks of a source, if it has as many words
_STEP = 1 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def shuffled(id_: Column) -> Column:
    """A number that puts ids in a shuffled order: the first 60 bits of the MD5 of the id as text."""
    return F.conv(F.substring(F.md5(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from rows of (source, size); one row per source."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.withColumn("_k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_k") % len(weights) + 1).cast("int"))
    full = ranked.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    w = Window.orderBy(F.col("_cap") / F.col("_w"), "_k")
    every = Window.partitionBy()
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rate = (F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / (
        F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    )
    stepped = full.withColumn("_rate", rate)
    # capped: all before the first source whose cap the common rate does not reach
    open_ = F.when(F.col("_rate") * F.col("_w") <= F.col("_cap"), F.struct("_cap_order", "_rate"))
    stepped = stepped.withColumn("_cap_order", F.row_number().over(w)).withColumn("_first", F.min(open_).over(every))
    capped = F.col("_first").isNull() | (F.col("_cap_order") < F.col("_first._cap_order"))
    target = F.when(capped, F.col("_cap")).otherwise(F.col("_first._rate") * F.col("_w"))
    return stepped.select("source", "source_size", target.alias("target"))


def _offsets(rows: DataFrame, amount: str, out: str) -> DataFrame:
    """``rows`` with the running total of ``amount`` before each row in its source, in shuffled order."""
    rows = rows.withColumn("_bucket", F.pmod(F.col("_order"), F.lit(_RUN)))
    inner = Window.partitionBy("_source", "_bucket").orderBy("_order", "_id", "_row").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("_source", "_bucket").agg(F.sum(amount).alias("_sum")).select("_source", "_bucket", F.coalesce(F.sum("_sum").over(outer), F.lit(0)).alias("_base"))
    placed = rows.withColumn("_in", F.coalesce(F.sum(amount).over(inner), F.lit(0)))
    return placed.join(totals, ["_source", "_bucket"]).withColumn(out, F.col("_base") + F.col("_in")).drop("_base", "_in", "_bucket")


def _quotas(targets: DataFrame, block_words: int, least: int) -> DataFrame:
    """Per source with words: number of blocks, quota in blocks, and its stretch of [0, 1)."""
    blocks = F.greatest(F.ceil(F.col("source_size") / F.lit(block_words)).cast("long"), F.least(F.col("source_size"), F.lit(least)))
    q = targets.where("source_size > 0").select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("_source"), "source_size", "target", blocks.alias("_blocks"))
    q = q.withColumn("_quota", F.col("target") / F.col("source_size") * F.col("_blocks"))
    order = Window.orderBy("_source")
    every = Window.partitionBy()
    high = F.sum("_quota").over(order) / F.sum("_quota").over(every)
    q = q.withColumn("_high", high).withColumn("_low", F.coalesce(F.lag("_high").over(order), F.lit(0.0)))
    return q.withColumn("_last", F.lead("_high").over(order).isNull())


def point(slot: Column, golden: float = GOLDEN) -> Column:
    """frac(slot * golden), the slot split so that no precision is lost at large numbers."""
    x = F.floor(slot / F.lit(_STEP)) * F.lit(math.fmod(_STEP * golden, 1.0)) + (slot % _STEP) * F.lit(golden)
    return x - F.floor(x)


def n_slots(quotas: DataFrame) -> int:
    return quotas.agg(F.ceil(F.sum("_quota") - 1e-6).cast("long")).first()[0] or 0


def schedule(quotas: DataFrame, slots: int, golden: float = GOLDEN) -> DataFrame:
    """(_source, _rank, _slot) of all slots.

    ``quotas`` is one row per source (see ``_quotas``). Points find their stretch by a join on a cell of
    a grid over [0, 1), so that the number of sources is not limited.
    """
    points = quotas.sparkSession.range(slots).select(F.col("id").alias("_slot"), point(F.col("id"), golden).alias("_point"))
    points = points.withColumn("_cell", F.floor(F.col("_point") * _GRID))
    cells = F.sequence(F.floor(F.col("_low") * _GRID), F.least(F.floor(F.col("_high") * _GRID), F.lit(_GRID - 1).cast("long")))
    stretches = quotas.select("_source", "_low", "_high", "_last", F.explode(cells).alias("_cell"))
    within = (F.col("_point") >= F.col("_low")) & ((F.col("_point") < F.col("_high")) | F.col("_last"))
    drawn = points.join(small_side(stretches), (points["_cell"] == stretches["_cell"]) & within)
    drawn = drawn.select("_source", "_slot", F.floor(F.col("_slot") / F.lit(_RUN)).alias("_run"))
    inner = Window.partitionBy("_source", "_run").orderBy("_slot")
    outer = Window.partitionBy("_source").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    counts = drawn.groupBy("_source", "_run").agg(F.count(F.lit(1)).alias("_n"))
    bases = counts.select("_source", "_run", F.coalesce(F.sum("_n").over(outer), F.lit(0)).alias("_base"))
    ranked = drawn.withColumn("_in", F.row_number().over(inner) - 1).join(bases, ["_source", "_run"])
    return ranked.select("_source", (F.col("_base") + F.col("_in")).alias("_rank"), "_slot")


def _placed(rows: DataFrame, quotas: DataFrame, slots: int, cap: float, golden: float) -> DataFrame:
    """(_row, taken, first_slot, _slots) of ``rows`` (_row, _id, _source, size): each document's overlap with the blocks taken, the
    first slot that takes of it, and the slots of the block it begins in (``cap`` at most)."""
    q = quotas.select("_source", "_blocks", F.col("source_size").alias("_total"))
    taken = (
        schedule(quotas, slots, golden).join(small_side(q), "_source")
        .where(F.col("_rank") < F.floor(F.lit(float(cap)) * F.col("_blocks")))
        .groupBy("_source", (F.col("_rank") % F.col("_blocks")).alias("_block"))
        .agg(F.count(F.lit(1)).alias("_times"), F.sort_array(F.collect_list("_slot")).alias("_slots"))
    )
    ordered = _offsets(rows.where("size > 0").withColumn("_order", shuffled(F.col("_id"))), "size", "_start")
    laid = ordered.drop("_order").join(small_side(q), "_source")
    lo = F.expr("cast(((_start + 1) * _blocks - 1) div _total as bigint)")
    hi = F.expr("cast(((_start + size) * _blocks - 1) div _total as bigint)")
    parts = laid.withColumn("_block", F.explode(F.sequence(lo, hi)))
    # block b holds the words w with ceil((w + 1) * blocks / total) - 1 = b, so it begins at floor(b * total / blocks)
    begin = F.expr("cast((_block * _total) div _blocks as bigint)")
    end = F.expr("cast(((_block + 1) * _total) div _blocks as bigint)")
    parts = parts.withColumn("_b0", begin).withColumn("_b1", end).join(taken, ["_source", "_block"], "left")
    overlap = F.least(F.col("_b1"), F.col("_start") + F.col("size")) - F.greatest(F.col("_b0"), F.col("_start"))
    return parts.groupBy("_row").agg(
        F.sum(F.coalesce("_times", F.lit(0)) * overlap).cast("long").alias("taken"), F.min(F.col("_slots")[0]).alias("first_slot"), F.min_by("_slots", F.when(F.col("_slots").isNotNull(), F.col("_block"))).alias("_slots"),
    )


def _sized(docs: DataFrame, row: Column, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(
        row.alias("_row"), F.col(id_col).alias("_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("")).alias("_source"),
    )


def _planned(rows: DataFrame, share: float, cap: float, block_words: int, least: int, golden: float) -> tuple[DataFrame, int]:
    """``rows`` (_row, _id, source, _source, size) with source_size, target, taken, first_slot and _slots; and the number of slots."""
    targets = checkpointed(source_targets(rows, share, cap))
    quotas = checkpointed(_quotas(targets, block_words, least))
    slots = n_slots(quotas)
    placed = _placed(rows.select("_row", "_id", "_source", "size"), quotas, slots, cap, golden)
    per = targets.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("_source"), "source_size", F.col("target").cast("double").alias("target"))
    return rows.join(small_side(per), "_source").join(placed, "_row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long")), slots


def mix_plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.5, cap: float = 2.0, block_words: int = 4096, least: int = LEAST, golden: float = GOLDEN
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_slot), one row per document."""
    # written once: the counting of words is the costly part, and the row numbers stay what they are
    rows = checkpointed(_sized(docs, F.monotonically_increasing_id(), id_col, text_col, source_col))
    plan, _ = _planned(rows, share, cap, block_words, least, golden)
    return plan.select(F.col("_id").alias("doc_id"), "size", "source_size", "target", "taken", "first_slot")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.5, cap: float = 2.0, block_words: int = 4096, least: int = LEAST, golden: float = GOLDEN, lot_words: int = 1 << 22
) -> DataFrame:
    """The mix itself, in the columns of ``docs`` and in the order of the schedule: each document as often as it is taken.

    A document taken ``c`` times whole and ``p`` words more gives ``c`` rows, and one row with its first ``p`` words where p > 0 (documents
    that meet a block's edge). A document of which nothing is taken gives no row, except one without words, which is passed on as it is.
    Partitions follow one another in the order of the slots, about ``lot_words`` words each, and are sorted by it within.
    """
    names = [f"_mx_{k}" for k in range(len(docs.columns))]  # whatever the columns are called
    of = dict(zip(docs.columns, names))
    numbered = checkpointed(docs.toDF(*names).withColumn("_mx_row", F.monotonically_increasing_id()))
    text = of[text_col]
    sized = checkpointed(_sized(numbered, F.col("_mx_row"), of[id_col], text, of[source_col]))
    plan, slots = _planned(sized, share, cap, block_words, least, golden)
    words = sized.agg(F.sum("size")).first()[0] or 0
    rows = numbered.join(plan.select(F.col("_row").alias("_mx_row"), "size", "taken", "_slots", "first_slot"), "_mx_row")
    rows = rows.withColumn("_mx_whole", F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("taken") / F.greatest("size", F.lit(1)))).cast("int"))
    rows = rows.withColumn("_mx_rest", F.when(F.col("size") == 0, 0).otherwise(F.col("taken") % F.greatest("size", F.lit(1))).cast("int"))
    n = F.col("_mx_whole") + (F.col("_mx_rest") > 0).cast("int")
    copies = rows.where(n > 0).withColumn("_mx_copy", F.explode(F.sequence(F.lit(1), n)))
    held = F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    head = F.array_join(F.slice(held, F.lit(1), F.col("_mx_rest")), "")
    cut = F.when(F.col("_mx_copy") <= F.col("_mx_whole"), F.col(text)).otherwise(head)
    lots = max(1, -(-int(share * words) // lot_words))
    slot = F.coalesce(F.element_at("_slots", F.least(F.col("_mx_copy"), F.size("_slots"))), "first_slot")
    # rows without words have no slot and are dealt by their number
    lot = F.coalesce(F.floor(slot * F.lit(lots) / F.lit(max(1, slots))), F.pmod("_mx_row", F.lit(lots))).cast("int")
    kept = [(cut if c == text else F.col(c)).alias(c) for c in names]
    dealt = copies.select(*kept, "_mx_row", "_mx_copy", slot.alias("_mx_slot"), lot.alias("_mx_lot")).repartitionById(lots, F.col("_mx_lot"))
    dealt = dealt.sortWithinPartitions(F.col("_mx_slot").asc_nulls_last(), "_mx_row", "_mx_copy")
    return dealt.select(*names).toDF(*docs.columns)
