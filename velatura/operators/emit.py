"""Emitters: what gives spans or logits for a text.

The reference quality comes from a trained token classifier, which is an outside part: pass its logits as a table
(``replay``) or as a function over batches (``external``). The rule emitter finds what has a fixed written form only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import taxonomy as tax

# Forms that the rules find; no name of a person has one.
RULES: tuple[tuple[str, str], ...] = (
    ("CONTATO", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("DOC_PESSOAL", r"[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}"),
    ("DOC_EMPRESA", r"[0-9]{2}\.[0-9]{3}\.[0-9]{3}/[0-9]{4}-[0-9]{2}"),
    ("DADO_FINANCEIRO", r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}"),
    ("ID_PROCESSUAL", r"[0-9]{3}\.[0-9]{3}\.[0-9]{3}/[0-9]{4}"),
    ("DATA_NASC", r"[0-9]{2}/[0-9]{2}/[0-9]{4}"),
)
MARGIN = 6.0


def rule_spans(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(…keys, start, end, type, value) of all matches of the rules.

    A text is cut by the pattern into gaps and matches, whose lengths add up to the offsets. Only texts with a match go on past the
    scan; a text's matches meet in one task.
    """
    text = F.col(text_col)
    parts = None
    for rank, (kind, form) in enumerate(RULES):
        hit = docs.where(text.rlike(form)).select(*keys, F.lit(rank).alias("_rule"), F.lit(kind).alias("type"), F.split(text, form, -1).alias("_gaps"), F.regexp_extract_all(text, F.lit(form), F.lit(0)).alias("_found"))
        parts = hit if parts is None else parts.unionByName(hit)
    rows = parts.select(*keys, "_rule", "type", F.posexplode(F.arrays_zip("_gaps", "_found")).alias("_pos", "_z"))
    rows = rows.select(*keys, "_rule", "type", "_pos", F.length("_z._gaps").alias("_gap"), F.col("_z._found").alias("value"))
    by = Window.partitionBy(*keys, "_rule").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("_gap") + F.coalesce(F.length("value"), F.lit(0))).over(by).cast("int")).where("value is not null")
    return rows.select(*keys, (F.col("end") - F.length("value")).cast("int").alias("start"), "end", "type", "value")


def rule_logits(tokens: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """``tokens`` with ``logits``: ``MARGIN`` for the label that the rule spans give a token, 0 for all others."""
    from .spans import gold_labels

    labelled = gold_labels(tokens, spans.select(*keys, "start", "end", "type"), keys)
    one = F.transform(F.sequence(F.lit(0), F.lit(len(tax.LABELS) - 1)), lambda i: F.when(i == F.greatest(F.col("label_id"), F.lit(0)), MARGIN).otherwise(0.0).cast("float"))
    return labelled.withColumn("logits", one).drop("label", "label_id")


def replay(tokens: DataFrame, emissions: DataFrame, keys: list[str]) -> DataFrame:
    """``tokens`` with the ``logits`` that a table holds for (…keys, start, end)."""
    return tokens.join(emissions.select(*keys, "start", "end", "logits"), [*keys, "start", "end"])


def external(chunks: DataFrame, model: Callable[[list[str]], list[list[tuple[int, int, list[float]]]]], keys: list[str], batch: int = 8) -> DataFrame:
    """(…keys, chunk_index, start, end, logits) from a model over batches of window texts.

    ``chunks`` has (…keys, chunk_index, char_start, text); ``model`` gives for each text (start, end, logits) of its tokens, in the
    text's own offsets, which become those of the whole text. It is loaded once per worker if it loads itself lazily.
    """
    kinds = ", ".join(f"`{k}` {chunks.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), batch):
                part = b.iloc[at : at + batch]
                rows = []
                for (_, r), found in zip(part.iterrows(), model(part["text"].tolist())):
                    rows += [(*[r[k] for k in keys], r["chunk_index"], s + r["char_start"], e + r["char_start"], x) for s, e, x in found if e > s]
                yield pd.DataFrame(rows, columns=[*keys, "chunk_index", "start", "end", "logits"])

    return chunks.select(*keys, "chunk_index", "char_start", "text").mapInPandas(run, f"{kinds}, chunk_index int, start int, end int, logits array<float>")


def publish_decision(docs: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """(…keys, n_spans, should_be_public), one row per document: public unless a span is of a personal type."""
    per = spans.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_spans"), F.bool_or(tax.is_pii(F.col("type"))).alias("_pii"))
    joined = docs.select(*keys).join(per, keys, "left")
    return joined.select(*keys, F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), (~F.coalesce("_pii", F.lit(False))).alias("should_be_public"))


def infer_records(docs: DataFrame, scored: DataFrame, keys: list[str]) -> DataFrame:
    """``docs`` with ``spans`` (type, start, end, value, conf to two places) in order, and ``should_be_public``; its other columns stay."""
    item = F.struct("start", "end", "type", F.col("confidence").alias("conf"))
    per = scored.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_s"))
    joined = docs.drop("spans", "should_be_public").join(per, keys, "left")
    spans = F.transform(F.coalesce("_s", F.array().cast("array<struct<start:int,end:int,type:string,conf:double>>")), lambda s: F.struct(
        s["type"].alias("type"), s["start"].alias("start"), s["end"].alias("end"),
        F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]).alias("value"), F.bround(s["conf"], 2).alias("conf"),
    ))
    return joined.withColumn("spans", spans).withColumn("should_be_public", ~F.exists("spans", lambda s: tax.is_pii(s["type"]))).drop("_s")
