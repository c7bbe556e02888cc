"""Review of label values: what a corpus holds, what a review keeps, what it adds."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import taxonomy as tax
from ..functions.rules import format_error
from ..functions.values import canonical


def mentions(docs: DataFrame, id_col: str = "row_id", normalize: bool = False, migrate: bool = False, pii_only: bool = False) -> DataFrame:
    """(row_id, ent_idx, type, value, text) of all entities in canonical form; ``pii_only`` looks at the type as given."""
    rows = docs.select(F.col(id_col).alias("row_id"), "text", F.posexplode("entities").alias("ent_idx", "_e"))
    if pii_only:
        rows = rows.where(tax.is_pii(F.col("_e.type")))
    kind, value = canonical(F.col("_e.type"), F.col("_e.value"), F.col("text"), normalize, migrate)
    rows = rows.withColumn("_c", F.struct(kind.alias("type"), value.alias("value")))
    return rows.select("row_id", "ent_idx", "_c.type", "_c.value", "text")


def mention_errors(rows: DataFrame, check_format: bool = False) -> DataFrame:
    """(row_id, ent_idx, type, value, error) of mentions that break a rule."""
    error = F.when(~F.col("type").isin(*tax.TYPES) | F.col("type").isNull(), "unknown_type").when(F.col("value").isNull() | (F.btrim("value") == ""), "empty").when(~F.col("text").contains(F.col("value")), "not_in_text")
    if check_format:
        error = error.otherwise(format_error(F.col("type"), F.col("value")))
    return rows.withColumn("error", error).where("error is not null").select("row_id", "ent_idx", "type", "value", "error")


def extract_values(rows: DataFrame) -> DataFrame:
    """(type, value, label_ord, value_ord): distinct values in the order in which labels, and values of a label, first appear."""
    first = rows.groupBy("type", "value").agg(F.min(F.struct("row_id", "ent_idx")).alias("_at"))
    by_value = Window.partitionBy("type").orderBy("_at")
    # the order of labels is one row per type, 13 at most
    labels = first.groupBy("type").agg(F.min("_at").alias("_first")).withColumn("label_ord", F.row_number().over(Window.orderBy("_first")) - 1)
    return first.withColumn("value_ord", F.row_number().over(by_value) - 1).join(F.broadcast(labels), "type").select("type", "value", "label_ord", "value_ord")


def kept_by_review(rows: DataFrame, review: DataFrame) -> DataFrame:
    """Mentions whose (type, value) the review holds, and all of types that it does not know; repeats stay."""
    known = review.select("type").distinct()
    held = rows.join(review.select("type", "value").distinct(), ["type", "value"], "left_semi")
    return held.unionByName(rows.join(known, "type", "left_anti").select(*held.columns))


def missing_labels(rows: DataFrame, review: DataFrame) -> DataFrame:
    """Types of mentions that the review does not know."""
    return rows.select("type").distinct().join(review.select("type").distinct(), "type", "left_anti")


def multi_label_values(review: DataFrame) -> DataFrame:
    """(value, n_types): values under more than one type."""
    return review.groupBy("value").agg(F.countDistinct("type").alias("n_types")).where("n_types > 1")


def contained_values(docs: DataFrame, values: list[str], id_col: str = "row_id", text_col: str = "text") -> DataFrame:
    """(row_id, value): which of the values each text holds, by one pass of a multi-pattern automaton over it.

    The values are a review's, so few enough for one automaton, which is made once per worker.
    """
    listed = sorted({v for v in values if v})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        find = ahocorasick.Automaton()
        for v in listed:
            find.add_word(v, v)
        if listed:
            find.make_automaton()
        for b in batches:
            found = [(i, v) for i, t in zip(b["row_id"], b["text"]) if listed and t for v in sorted({v for _, v in find.iter(t)})]
            yield pd.DataFrame(found, columns=["row_id", "value"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("row_id"), F.col(text_col).alias("text")).mapInPandas(run, f"row_id {kind}, value string")


def added_by_review(docs: DataFrame, kept: DataFrame, review: DataFrame, id_col: str = "row_id") -> DataFrame:
    """(row_id, type, value, label_ord, value_ord): the review's values that a text holds and the kept mentions lack, in the review's order."""
    listed = [r[0] for r in review.select("value").distinct().collect()]  # a review dictionary
    found = contained_values(docs, listed, id_col).join(review.select("type", "value", "label_ord", "value_ord"), "value")
    return found.join(kept.select("row_id", "type", "value").distinct(), ["row_id", "type", "value"], "left_anti").select("row_id", "type", "value", "label_ord", "value_ord")


def apply_review(docs: DataFrame, review: DataFrame, id_col: str = "row_id", normalize: bool = False, migrate: bool = False, add_missing: bool = False) -> DataFrame:
    """``docs`` with ``entities`` as the review leaves them: kept ones in their order, then added ones in the review's; other columns stay."""
    kept = kept_by_review(mentions(docs, id_col, normalize, migrate), review)
    rows = kept.select("row_id", F.lit(0).alias("_part"), "ent_idx", F.lit(0).alias("_next"), "type", "value")
    if add_missing:
        more = added_by_review(docs, kept, review, id_col)
        rows = rows.unionByName(more.select("row_id", F.lit(1).alias("_part"), F.col("label_ord").alias("ent_idx"), F.col("value_ord").alias("_next"), "type", "value"))
    per = rows.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("_part", "ent_idx", "_next", "type", "value"))).alias("_e"))
    none = F.array().cast("array<struct<type:string,value:string>>")
    made = F.coalesce(F.transform("_e", lambda e: F.struct(e["type"].alias("type"), e["value"].alias("value"))), none)
    joined = docs.join(per.withColumnRenamed("row_id", "_rid"), F.col(id_col) == F.col("_rid"), "left")
    return joined.select(*[made.alias(c) if c == "entities" else F.col(c) for c in docs.columns])


def value_type_conflicts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(…keys, value, n_types): values that stand for more than one type within a row."""
    return rows.groupBy(*keys, "value").agg(F.countDistinct("type").alias("n_types")).where("n_types > 1")
