"""Evaluation of predicted against gold labels and spans: tokens, spans, documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import taxonomy as tax
from ..functions.text import excerpt

PII_IDS = tuple(i for i, x in enumerate(tax.LABELS) if x[2:] in tax.PII_TYPES)
ENTITY_IDS = tuple(range(1, len(tax.LABELS)))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def prf(tp: str = "tp", pred: str = "pred_pos", true: str = "true_pos") -> dict[str, Column]:
    """precision, recall and f1 from counts; 0 where there is nothing to divide by."""
    p, r = _ratio(F.col(tp), F.col(pred)), _ratio(F.col(tp), F.col(true))
    return {"precision": p, "recall": r, "f1": F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))}


def with_prf(df: DataFrame) -> DataFrame:
    return df.withColumns(prf())


def token_counts(pairs: DataFrame) -> DataFrame:
    """(scope, pred_pos, true_pos, tp) for personal and for all entities, from tokens (pred_id, gold_id); ignored gold labels are left out."""
    rows = pairs.where(F.col("gold_id") != tax.IGNORED)
    out = []
    for scope, ids in (("pii", PII_IDS), ("all", ENTITY_IDS)):
        p, y = F.col("pred_id").isin(*ids), F.col("gold_id").isin(*ids)
        out += [F.count_if(p).alias(f"{scope}_pred_pos"), F.count_if(y).alias(f"{scope}_true_pos"), F.count_if(p & y & (F.col("pred_id") == F.col("gold_id"))).alias(f"{scope}_tp")]
    wide = rows.agg(*out)
    sides = [F.struct(F.lit(s).alias("scope"), *[F.col(f"{s}_{c}").alias(c) for c in ("pred_pos", "true_pos", "tp")]) for s in ("pii", "all")]
    return wide.select(F.inline(F.array(*sides)))


def span_counts(gold: DataFrame, pred: DataFrame, keys: list[str]) -> DataFrame:
    """(type, pred_pos, true_pos, tp): one row per type of the taxonomy, and the totals ``PII`` and ``ALL``; a match is exact."""
    g = gold.select(*keys, "start", "end", "type", F.lit(1).alias("_g"))
    p = pred.select(*keys, "start", "end", "type", F.lit(1).alias("_p"))
    both = g.unionByName(p, allowMissingColumns=True).groupBy(*keys, "start", "end", "type").agg(F.sum("_g").alias("_g"), F.sum("_p").alias("_p"))
    sums = [F.coalesce(F.sum("_p"), F.lit(0)).alias("pred_pos"), F.coalesce(F.sum("_g"), F.lit(0)).alias("true_pos"), F.count_if(F.col("_g").isNotNull() & F.col("_p").isNotNull()).alias("tp")]
    per = both.groupBy("type").agg(*sums)
    kinds = both.sparkSession.createDataFrame([(t,) for t in tax.TYPES], "type string")
    each = kinds.join(per, "type", "left").select("type", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("pred_pos", "true_pos", "tp")])
    total = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("pred_pos", "true_pos", "tp")]
    pii = each.where(tax.is_pii(F.col("type"))).agg(*total).select(F.lit("PII").alias("type"), "pred_pos", "true_pos", "tp")
    return each.unionByName(pii).unionByName(each.agg(*total).select(F.lit("ALL").alias("type"), "pred_pos", "true_pos", "tp"))


def document_flags(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Per document, from its tokens: pred_has_pii, gold_has_pii, pred_has_entity, gold_has_entity, pii_token_error, entity_token_error."""
    rows = pairs.where(F.col("gold_id") != tax.IGNORED)
    p, y = F.col("pred_id"), F.col("gold_id")
    out = []
    for name, error, ids in (("pii", "pii_token_error", PII_IDS), ("entity", "entity_token_error", ENTITY_IDS)):
        a, b = p.isin(*ids), y.isin(*ids)
        out += [F.bool_or(a).alias(f"pred_has_{name}"), F.bool_or(b).alias(f"gold_has_{name}"), F.bool_or(F.when(a, p).otherwise(0) != F.when(b, y).otherwise(0)).alias(error)]
    return rows.groupBy(*keys).agg(*out)


def bucket(pred: Column, gold: Column) -> Column:
    return F.when(pred & gold, "tp").when(pred, "fp").when(gold, "fn").otherwise("tn")


def binary_counts(flags: DataFrame, pred: str, gold: str) -> DataFrame:
    """(tp, tn, fp, fn, precision, recall, f1, accuracy) of two boolean columns, in one row."""
    which = bucket(F.coalesce(pred, F.lit(False)), F.coalesce(gold, F.lit(False)))
    n = flags.select(which.alias("b")).agg(*[F.count_if(F.col("b") == k).alias(k) for k in ("tp", "tn", "fp", "fn")])
    made = n.withColumn("pred_pos", F.col("tp") + F.col("fp")).withColumn("true_pos", F.col("tp") + F.col("fn")).withColumns(prf())
    total = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    return made.withColumn("accuracy", _ratio(F.col("tp") + F.col("tn"), total)).drop("pred_pos", "true_pos")


def samples(docs: DataFrame, flags: DataFrame, keys: list[str], most: int = 200) -> DataFrame:
    """One record per document: decisions, buckets, errors, excerpt, entities."""
    shown = docs.select(*keys, excerpt(F.col("text"), most).alias("excerpt"), "entities")  # before the join, which need not move whole texts
    joined = shown.join(flags, keys)
    pii = bucket(F.col("pred_has_pii"), F.col("gold_has_pii"))
    return joined.select(
        *keys, (~F.col("gold_has_pii")).alias("gold_should_be_public"), (~F.col("pred_has_pii")).alias("pred_should_be_public"), pii.alias("pii_bucket"),
        bucket(F.col("pred_has_entity"), F.col("gold_has_entity")).alias("entity_bucket"), "pii_token_error", "entity_token_error",
        pii.isin("fp", "fn").alias("binary_error"), "excerpt", "entities",
    )


#: Lists of samples by name: the condition under which a sample belongs.
SAMPLE_LISTS = {
    "any_error": "pii_token_error or binary_error", "token_error": "pii_token_error", "binary_error": "binary_error",
    "fp": "pii_bucket = 'fp'", "fn": "pii_bucket = 'fn'", "tp": "pii_bucket = 'tp'", "tn": "pii_bucket = 'tn'",
}


def training_metric(pairs: DataFrame) -> DataFrame:
    """Micro precision, recall and f1 over labels other than O, ignored labels left out."""
    rows = pairs.where(F.col("gold_id") != tax.IGNORED)
    p, y = F.col("pred_id") != 0, F.col("gold_id") != 0
    return with_prf(rows.agg(F.count_if(p).alias("pred_pos"), F.count_if(y).alias("true_pos"), F.count_if(p & y & (F.col("pred_id") == F.col("gold_id"))).alias("tp")))


def split(df: DataFrame, id_col: str, share: float = 0.1, seed: int = 42) -> DataFrame:
    """``df`` with ``part``: ``valid`` for about ``share`` of the ids, by a hash, else ``train``; the same at every size and in every run."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary")), 1, 8), 16, 10).cast("long")
    return df.withColumn("part", F.when(h < int(share * (1 << 32)), "valid").otherwise("train"))


def metrics_json(token: DataFrame, span: DataFrame, pii_binary: DataFrame, all_binary: DataFrame, report_path: str) -> DataFrame:
    """One row, one column ``json``: the metrics in their published shape. The four tables, of 16 rows at most, are worked out once each."""
    counts, cols = ("precision", "recall", "f1", "tp", "pred_pos", "true_pos"), ("precision", "recall", "f1", "accuracy", "tp", "tn", "fp", "fn")
    token, span = with_prf(token), with_prf(span)
    t, p = {r["scope"]: r for r in token.collect()}, {r["type"]: r for r in span.collect()}
    b = {"pii": pii_binary.first(), "all": all_binary.first()}
    struct = lambda df, names: T.StructType([df.schema[n] for n in names])
    of = lambda row, names: tuple(row[n] for n in names)
    each = T.StructType([span.schema["type"], T.StructField("counts", struct(span, counts))])
    parts = {}
    for scope, name in (("pii", "pii"), ("all", "all_entities")):
        parts[f"{name}_token_level"] = struct(token, counts), of(t[scope], counts)
        parts[f"{name}_binary"] = struct(pii_binary, cols), of(b[scope], cols)
        parts[f"{name}_p1"] = pii_binary.schema["f1"].dataType, b[scope]["f1"]
    for scope, name in (("PII", "pii"), ("ALL", "all_entities")):
        parts[f"{name}_span_level"] = struct(span, counts), of(p[scope], counts)
    parts["per_type_span_level"] = T.ArrayType(each), [(k, of(p[k], counts)) for k in sorted(p) if k in tax.TYPES]
    row = token.sparkSession.createDataFrame([tuple(v for _, v in parts.values())], T.StructType([T.StructField(k, kind) for k, (kind, _) in parts.items()]))
    row = row.withColumn("per_type_span_level", F.map_from_entries("per_type_span_level")).withColumn("report_path", F.lit(report_path))
    return row.select(F.to_json(F.struct("*")).alias("json"))


def empty_pairs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "doc_id long, tok_idx int, pred_id int, gold_id int")
