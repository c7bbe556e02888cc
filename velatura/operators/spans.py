"""Character spans: from labelled tokens, merged, filtered, resolved; gold spans and labels of tokens.

Where a decision needs only sums and maxima over what comes before, it is a window over one document; where each
decision depends on the one before, it is an ordered fold over the document's spans inside one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import taxonomy as tax
from ..functions.batches import in_batches
from ..functions.text import let, occurrences
from ..functions.values import gold_form
from .tokens import BATCH_TOKENS, offsets


def _islands(tokens: DataFrame, keys: list[str], order: str, entity: Column, prefix: Column, kind: Column) -> DataFrame:
    """Tokens of entities with ``_island``: a new one after anything else, at a B, and where the type changes."""
    by = Window.partitionBy(*keys).orderBy(order)
    rows = tokens.withColumn("_kind", F.when(entity, kind)).withColumn("_begins", F.when(entity & (prefix == "B"), 1).otherwise(0))
    before = F.lag("_kind").over(by)
    new = F.when(F.col("_kind").isNotNull() & ((F.col("_begins") == 1) | ~before.eqNullSafe(F.col("_kind"))), 1).otherwise(0)
    rows = rows.withColumn("_new", new).withColumn("_island", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.where("_kind is not null")


def bio_spans_known(tokens: DataFrame, keys: list[str], label_id: str, id_before: str, order: str = "tok_idx") -> DataFrame:
    """As ``bio_spans``, from tokens of a text (start, end) whose label ids and those of the tokens before them are known: only tokens of entities are shuffled."""
    now, before = tax.id_to_label(F.col(label_id)), tax.id_to_label(F.col(id_before))
    rows = tokens.select(*keys, order, "start", "end", now.alias("_now"), before.alias("_before")).where("_now <> 'O'")
    new = F.when((F.col("_now").startswith("B")) | (F.substring("_now", 3, 99) != F.substring("_before", 3, 99)), 1).otherwise(0)
    rows = rows.select(*keys, order, "start", "end", F.substring("_now", 3, 99).alias("type"), new.alias("_new"))
    by = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumn("_island", F.sum("_new").over(by)).groupBy(*keys, "_island")
    return out.agg(F.min_by("start", order).alias("start"), F.max("end").alias("end"), F.first("type").alias("type")).select(*keys, "start", "end", "type")


def bio_spans(tokens: DataFrame, keys: list[str], order: str = "tok_idx", label: str = "label") -> DataFrame:
    """(…keys, start, end, type) from tokens (start, end, label).

    Tokens at (0, 0) and O end a span. A label without a hyphen or without a type is passed over, as if its token
    were not there; anything but B before the hyphen continues a span of its type, or begins one.
    """
    lab = F.col(label)
    special = (F.col("start") == 0) & (F.col("end") == 0)
    kind = F.when(lab.contains("-"), F.split(lab, "-", 2)[1])
    shaped = special | (lab == "O") | (F.length(kind) > 0)
    rows = tokens.where(F.coalesce(shaped, F.lit(False)))
    islands = _islands(rows, keys, order, ~special & (lab != "O"), F.substring_index(lab, "-", 1), kind)
    out = islands.groupBy(*keys, "_island").agg(F.min_by("start", order).alias("start"), F.max("end").alias("end"), F.first("_kind").alias("type"))
    return out.select(*keys, "start", "end", "type")


def bio_spans_scored(tokens: DataFrame, keys: list[str], how: str = "mean", order: str = "tok_idx", label: str = "label", prob: str = "prob") -> DataFrame:
    """(…keys, start, end, type, confidence, n_tokens) from tokens (start, end, label, prob); labels that are no BIO labels end a span."""
    if how not in ("mean", "min"):
        raise ValueError(f"confidence is 'mean' or 'min', not {how!r}")
    lab = F.col(label)
    special = (F.col("start") == 0) & (F.col("end") == 0)
    islands = _islands(tokens, keys, order, ~special & F.coalesce(tax.is_bio(lab) & (lab != "O"), F.lit(False)), tax.bio_prefix(lab), tax.bio_type(lab))
    conf = F.avg(prob) if how == "mean" else F.min(prob)
    out = islands.groupBy(*keys, "_island").agg(
        F.min_by("start", order).alias("start"), F.max("end").alias("end"), F.first("_kind").alias("type"), conf.cast("double").alias("confidence"), F.count(F.lit(1)).cast("int").alias("n_tokens")
    )
    return out.select(*keys, "start", "end", "type", "confidence", "n_tokens")


def merge_spans(spans: DataFrame, keys: list[str], scored: bool = False) -> DataFrame:
    """Spans of one type that overlap or touch, merged; scored ones keep the largest confidence and the sum of tokens."""
    by = Window.partitionBy(*keys, "type").orderBy("start", "end")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    rows = spans.withColumn("_new", F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0))
    rows = rows.withColumn("_group", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    more = [F.max("confidence").alias("confidence"), F.sum("n_tokens").cast("int").alias("n_tokens")] if scored else []
    return rows.groupBy(*keys, "type", "_group").agg(F.min("start").alias("start"), F.max("end").alias("end"), *more).drop("_group").select(
        *keys, "start", "end", "type", *(["confidence", "n_tokens"] if scored else [])
    )


def filter_spans(spans: DataFrame, threshold: float = 0.0, min_tokens: int = 0, threshold_by_type: dict[str, float] | None = None, min_tokens_by_type: dict[str, int] | None = None) -> DataFrame:
    """Scored spans of enough tokens and confidence; a bound of 0 or less lets all pass, a type's own bound replaces the general one."""

    def bound(general: float, own: dict | None) -> Column:
        out = F
        for k, v in (own or {}).items():
            out = out.when(F.col("type") == k, F.lit(v))
        return F.lit(general) if out is F else out.otherwise(F.lit(general))

    th, least = bound(float(threshold), threshold_by_type), bound(int(min_tokens), min_tokens_by_type)
    return spans.where(((least <= 0) | (F.col("n_tokens") >= least)) & ((th <= 0) | (F.col("confidence") >= th)))


_SCORED = "array<struct<start:int,end:int,type:string,confidence:double,n_tokens:int>>"


def resolve_overlaps(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Merged scored spans of which none overlaps the one kept before it.

    In order of (start, end, type), a span that overlaps the last one kept and is of another type replaces it if its
    confidence is higher, or equal and it is longer; else it goes.
    """
    rows = spans.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("start", "end", "type", "confidence", "n_tokens"))).alias("_all"))
    return rows.select(*keys, F.inline(let(F.col("_all").cast(_SCORED), _resolved)))


def _resolved(ordered: Column) -> Column:
    """The spans kept of an ordered list, which is not empty.

    Only the last span kept can still go, so it is held apart from those that stay. Adding to an array copies it, so those are added to
    blocks of about sqrt(n), and blocks to the list of blocks: n spans take n * sqrt(n) copies instead of n * n.
    """
    none = F.slice(ordered, 1, 0)
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(ordered))).cast("int"))

    def step(acc: Column, s: Column) -> Column:
        last = acc["last"]
        clash = (s["start"] < last["end"]) & (s["type"] != last["type"])
        better = (s["confidence"] > last["confidence"]) | (s["confidence"] == last["confidence"]) & (s["end"] - s["start"] > last["end"] - last["start"])
        return F.when(~clash, F.struct(s.alias("last"), F.array_append(acc["out"], last).alias("out"))).when(better, F.struct(s.alias("last"), acc["out"].alias("out"))).otherwise(acc)

    def block(acc: Column, at: Column) -> Column:
        done = F.aggregate(F.slice(ordered, at, width), F.struct(acc["last"].alias("last"), none.alias("out")), step)
        return let(done, lambda x: F.struct(x["last"].alias("last"), F.array_append(acc["out"], x["out"]).alias("out")))

    firsts = F.when(F.size(ordered) > 1, F.sequence(F.lit(2), F.size(ordered), width)).otherwise(F.array().cast("array<int>"))
    start = F.struct(F.get(ordered, F.lit(0)).alias("last"), F.slice(F.array(none), 1, 0).alias("out"))
    return F.aggregate(firsts, start, block, lambda acc: F.array_append(F.flatten(acc["out"]), acc["last"]))


def cross_type_overlaps(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of overlapping spans of different types, the earlier one first (equi-join on the document, range within it)."""
    a = spans.select(*keys, F.col("start").alias("start_a"), F.col("end").alias("end_a"), F.col("type").alias("type_a"))
    b = spans.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("start").alias("start_b"), F.col("end").alias("end_b"), F.col("type").alias("type_b"))
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    on = (F.col("start_a") < F.col("end_b")) & (F.col("start_b") < F.col("end_a")) & (F.struct("start_a", "end_a", "type_a") < F.struct("start_b", "end_b", "type_b"))
    for s in same:
        on &= s
    return a.join(b, on & (F.col("type_a") != F.col("type_b"))).drop(*[f"_{k}" for k in keys])


# --- annotated documents ------------------------------------------------------------------------


def _literal(gold: bool) -> Column:
    """The literal occurrences of a row's entities in its text, distinct."""
    ents = F.col("entities")
    if gold:
        ents = F.transform(ents, lambda e: gold_form(e["type"], e["value"], F.col("text")))
    spans = F.flatten(F.transform(ents, lambda e: F.transform(
        occurrences(F.col("text"), e["value"]), lambda a: F.struct(a.alias("start"), (a + F.length(e["value"])).alias("end"), e["type"].alias("type"))
    )))
    return F.array_distinct(spans)


def literal_spans(docs: DataFrame, keys: list[str], gold: bool = False) -> DataFrame:
    """(…keys, start, end, type), distinct, of all literal occurrences of the entities (array of type, value) of each text.

    ``gold`` puts the entities in the form of gold spans first. All within a row.
    """
    return docs.select(*keys, F.inline(_literal(gold)))


def _apart(ordered: Column) -> Column:
    """Of an ordered list of spans those that overlap none before them that stays."""

    def fold(kept: Column, s: Column) -> Column:
        return F.when(F.exists(kept, lambda k: (s["start"] < k["end"]) & (s["end"] > k["start"])), kept).otherwise(F.array_append(kept, s))

    return let(ordered, lambda x: F.aggregate(x, F.slice(x, 1, 0), fold))


def gold_spans(docs: DataFrame, keys: list[str]) -> DataFrame:
    """(…keys, start, end, type): of the literal spans those that overlap none that is longer, else earlier, else first by type."""
    found = literal_spans(docs, keys, gold=True)
    ordered = F.array_sort(F.collect_list(F.struct((F.col("start") - F.col("end")).alias("less"), "start", "end", "type")))
    rows = found.groupBy(*keys).agg(ordered.alias("_all"))
    return rows.select(*keys, F.inline(_apart(F.col("_all")))).drop("less")


def _label_ids(starts: np.ndarray, ends: np.ndarray, spans: list[dict]) -> np.ndarray:
    """The label id of each token of a text by spans (start, end, type); of several labels of a token the first by name counts."""
    rank = np.full(len(starts), len(_BY_NAME), np.int32)
    for s in spans:
        a, b = np.searchsorted(ends, s["start"], "right"), np.searchsorted(starts, s["end"], "left")
        if a < b:
            rank[a] = min(rank[a], _RANK[f"B-{s['type']}"])
            np.minimum(rank[a + 1 : b], _RANK[f"I-{s['type']}"], out=rank[a + 1 : b])
    return _ID_OF_RANK[rank]


_BY_NAME = sorted(tax.LABELS[1:])
_RANK = {x: i for i, x in enumerate(_BY_NAME)}
_ID_OF_RANK = np.array([tax.LABELS.index(x) for x in (*_BY_NAME, "O")], np.int32)


def gold_token_rows(docs: DataFrame, keys: list[str]) -> DataFrame:
    """(…keys, tok_idx, start, end, label_id, id_before): the tokens of each text with the label ids of its gold spans, and that of the token before (O for the first).

    As ``gold_labels`` of ``token_rows`` by ``gold_spans``, for ``docs`` of a row per document with entities of the taxonomy's types. Texts
    are cut and labelled within their row, so no token is shuffled. Rows without a key have no spans, as in a join.
    """
    held = F.transform(_literal(gold=True), lambda s: F.struct((s["start"] - s["end"]).alias("less"), s["start"].alias("start"), s["end"].alias("end"), s["type"].alias("type")))
    keyed = F.lit(True)
    for k in keys:
        keyed &= F.col(k).isNotNull()
    rows = docs.withColumn("_all", F.when(keyed, F.array_sort(held)))
    rows = rows.select(*keys, "text", F.transform(_apart(F.col("_all")), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["type"].alias("type"))).alias("_gold"))

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tokens_of(b: pa.RecordBatch, made: list[tuple[np.ndarray, ...]], last: int) -> pa.RecordBatch:
            """The tokens of the rows of ``b`` that were made last, the last of them being ``last``."""
            sizes = [len(s) for s, _, _ in made]
            of_row = pa.array(np.repeat(np.arange(last + 1 - len(made), last + 1), sizes))
            starts, ends, ids = (np.concatenate(x) for x in zip(*made))
            at = np.concatenate([np.arange(n) for n in sizes])
            before = np.where(at == 0, 0, np.r_[np.zeros(min(1, len(ids)), int), ids[:-1]])
            return pa.RecordBatch.from_arrays([*(b.column(k).take(of_row) for k in keys), *(pa.array(x, pa.int32()) for x in (at, starts, ends, ids, before))], [*keys, "tok_idx", "start", "end", "label_id", "id_before"])

        for b in batches:
            made, size = [], 0
            for i, (text, gold) in enumerate(zip(b.column("text"), b.column("_gold"))):
                s, e = offsets(text.as_py())
                made.append((s, e, _label_ids(s, e, gold.as_py() or [])))
                size += len(s)
                if size >= BATCH_TOKENS or i + 1 == b.num_rows:
                    yield tokens_of(b, made, i)
                    made, size = [], 0

    return in_batches(rows).mapInArrow(run, f"{kinds}, tok_idx int, start int, end int, label_id int, id_before int")


def aligned(tokens: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """(…keys, start, end, type, tok_idx): the tokens that each span touches, those at (0, 0) left out."""
    t = tokens.where("not (start = 0 and end = 0)").select(*[F.col(k).alias(f"_{k}") for k in keys], "tok_idx", F.col("start").alias("_a"), F.col("end").alias("_b"))
    on = (F.col("_a") < F.col("end")) & (F.col("_b") > F.col("start"))
    for k in keys:
        on &= F.col(k) == F.col(f"_{k}")
    return spans.join(t, on).select(*keys, "start", "end", "type", "tok_idx")


def _labelled(tokens: DataFrame, tags: DataFrame, keys: list[str]) -> DataFrame:
    """All tokens with a label: that of ``tags`` (…keys, tok_idx, tag), else O, or none for special ones."""
    special = (F.col("start") == 0) & (F.col("end") == 0)
    label = F.when(special, F.lit(None).cast("string")).otherwise(F.coalesce("tag", F.lit("O")))
    out = tokens.join(tags, [*keys, "tok_idx"], "left").withColumn("label", label)
    return out.withColumn("label_id", F.when(F.col("label").isNull(), F.lit(tax.IGNORED)).otherwise(tax.label_to_id(F.col("label")))).drop("tag")


def gold_labels(tokens: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """``tokens`` with ``label`` and ``label_id`` by non-overlapping gold spans; spans past the tokens are left out."""
    touched = aligned(tokens, spans, keys)
    first = F.min("tok_idx").over(Window.partitionBy(*keys, "start", "end", "type"))
    tags = touched.withColumn("tag", F.concat(F.when(F.col("tok_idx") == first, "B-").otherwise("I-"), "type"))
    return _labelled(tokens, tags.groupBy(*keys, "tok_idx").agg(F.min("tag").alias("tag")), keys)


def unaligned(tokens: DataFrame, spans: DataFrame, keys: list[str], past_end: bool = False) -> DataFrame:
    """Spans that touch no token; those past the last token count only with ``past_end``."""
    lost = spans.join(aligned(tokens, spans, keys).select(*keys, "start", "end", "type").distinct(), [*keys, "start", "end", "type"], "left_anti")
    if past_end:
        return lost
    ends = tokens.groupBy(*keys).agg(F.max("end").alias("_covered"))
    return lost.join(ends, keys, "left").where("start < coalesce(_covered, 0)").drop("_covered")


def train_labels(tokens: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """``tokens`` with ``label`` and ``label_id``: of spans that share tokens those of most tokens, else longest, else first, win."""
    touched = aligned(tokens, spans, keys).groupBy(*keys, "start", "end", "type").agg(F.min("tok_idx").alias("a"), F.max("tok_idx").alias("b"), F.count(F.lit(1)).alias("n"))
    key = F.struct((-F.col("n")).alias("less_tokens"), (F.col("start") - F.col("end")).alias("less_length"), "start", "end", "type", "a", "b")
    rows = touched.groupBy(*keys).agg(F.array_sort(F.collect_list(key)).alias("_all"))

    def fold(kept: Column, s: Column) -> Column:
        return F.when(F.exists(kept, lambda k: (s["a"] <= k["b"]) & (s["b"] >= k["a"])), kept).otherwise(F.array_append(kept, s))

    won = rows.select(*keys, F.inline(F.aggregate("_all", F.slice("_all", 1, 0), fold))).select(*keys, "start", "end", "type")
    return gold_labels(tokens, won, keys)


def covered_pieces(spans: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """(…keys, start, end, type, chunk_index, a, b): the part [a, b) of each span that a window holds."""
    w = windows.select(*[F.col(k).alias(f"_{k}") for k in keys], "chunk_index", "char_start", "char_end")
    on = (F.col("start") < F.col("char_end")) & (F.col("end") > F.col("char_start"))
    for k in keys:
        on &= F.col(k) == F.col(f"_{k}")
    return spans.join(w, on).select(*keys, "start", "end", "type", "chunk_index", F.greatest("start", "char_start").alias("a"), F.least("end", "char_end").alias("b"))


def coverage(spans: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """(…keys, start, end, type, covered): whether the windows hold all of each span without a gap."""
    own = [*keys, "start", "end", "type"]
    by = Window.partitionBy(*own).orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    pieces = covered_pieces(spans, windows, keys).withColumn("_gap", F.col("a") - F.coalesce(F.max("b").over(by), F.col("start")))
    whole = pieces.groupBy(*own).agg(((F.max("_gap") <= 0) & (F.max("b") >= F.col("end"))).alias("covered"))
    return spans.join(whole, own, "left").withColumn("covered", F.coalesce("covered", F.lit(False)))


def slices(docs: DataFrame, spans: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """(…keys, chunk_index, type, value), distinct: what of each span's text lies in each window."""
    pieces = covered_pieces(spans, windows, keys).join(docs.select(*keys, "text"), keys)
    return pieces.select(*keys, "chunk_index", "type", F.substring(F.col("text"), F.col("a") + 1, F.col("b") - F.col("a")).alias("value")).distinct()
