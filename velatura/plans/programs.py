"""The programs of the engine end to end: extract, apply, chunk, prepare, infer, evaluate.

Each reads and writes the files that a user hands over; in between everything is one plan. Rows are numbered by the lines
of the input, from 0.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import taxonomy as tax
from ..operators import decode, emit, evaluate, report, review, spans, tokens
from ..sources import jsonl

ROW = ["row_id"]
LEGACY = "pii_candidate"


def _stop(bad: DataFrame, what: str, order: str = "row_id") -> None:
    """Raise with the first few broken rows, if there are any."""
    found = bad.orderBy(order).limit(5).collect()
    if found:
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in found))


def load(spark: SparkSession, path: str, blank: str = "skip", max_rows: int = -1, text_column: str = "text", entities_column: str = "entities", need_entities: bool = True) -> DataFrame:
    """(row_id, text, entities, line) of a JSON lines file; broken lines, legacy rows and missing columns stop the program."""
    schema = f"`{text_column}` string, `{entities_column}` array<struct<type:string,value:string>>, {LEGACY} string"
    rows = jsonl.read_documents(spark, path, schema, blank=blank)
    _stop(rows.where("problem is not null").select("line_no", "problem"), path, "line_no")
    _stop(rows.where(f"{LEGACY} is not null and `{entities_column}` is null").select("line_no"), f"{path}: legacy column {LEGACY}", "line_no")
    rows = rows.select("row_id", F.col(f"`{text_column}`").alias("text"), F.col(f"`{entities_column}`").alias("entities"), "line")
    _stop(rows.where("text is null").select("row_id"), f"{path}: no text")
    if need_entities:
        _stop(rows.where("entities is null").select("row_id"), f"{path}: no entities")
    return rows.where(F.col("row_id") < max_rows) if max_rows > 0 else rows


def extract(spark: SparkSession, input_path: str, output_path: str, normalize: bool = False, migrate: bool = False, validate: bool = False, pii_only: bool = False) -> None:
    """Distinct values per label, in order of first appearance, as a review dictionary."""
    docs = load(spark, input_path, blank="error")
    found = review.mentions(docs, "row_id", normalize, migrate, pii_only)
    _stop(review.mention_errors(found, validate), input_path)
    jsonl.write_review(review.extract_values(found), output_path)


def apply(
    spark: SparkSession, input_path: str, review_path: str, output_path: str, normalize: bool = False, migrate: bool = False, validate: bool = False, add_missing: bool = False,
    require_all_labels: bool = False, allow_value_in_multiple_labels: bool = False,
) -> None:
    """The documents with the entities that the review leaves, as JSON lines in the order of the input; other keys stay."""
    table = jsonl.read_review(spark, review_path, validate)
    if not allow_value_in_multiple_labels:
        _stop(review.multi_label_values(table), f"{review_path}: values under several labels", "value")
    docs = load(spark, input_path, blank="error")
    found = review.mentions(docs, "row_id", normalize, migrate)
    _stop(review.mention_errors(found, validate), input_path)
    if require_all_labels:
        _stop(review.missing_labels(found, table), f"{review_path}: labels missing", "type")
    out = review.apply_review(docs.select("row_id", "text", "entities", "line"), table, "row_id", normalize, migrate, add_missing)
    keys = [f for f in spark.read.json(input_path).schema if f.name not in ("text", "entities", "_corrupt_record")]
    more = F.from_json("line", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys)) if keys else None
    columns = ["text", "entities", *([F.col(f"_m.`{f.name}`").alias(f.name) for f in keys])]
    out = (out.withColumn("_m", more) if keys else out).select("row_id", *columns)
    jsonl.write_jsonl(out, output_path, order="row_id", mode="overwrite")


def chunk(spark: SparkSession, input_path: str, output_path: str, max_length: int = 512, stride: int = 64, backoff: int = 32) -> int:
    """Windows of the documents with the entity values that each holds, as JSON lines; gives the number of windows."""
    docs = load(spark, input_path)
    _stop(jsonl.schema_violations(docs), input_path)
    found = spans.literal_spans(docs, ROW)
    _stop(spans.cross_type_overlaps(found, ROW), f"{input_path}: overlapping types")
    made = tokens.chunks(tokens.tokenize(docs), "row_id", max_length=max_length, stride=stride, backoff=backoff)
    _stop(made.where("not fits").select("row_id", "chunk_index", "n_retok"), f"windows over {max_length} tokens")
    _stop(spans.coverage(found, made, ROW).where("not covered"), "entities not covered by windows")
    held = spans.slices(docs, found, made, ROW)
    _stop(review.value_type_conflicts(held, ["row_id", "chunk_index"]), "one value under two types in a window")
    per = held.groupBy("row_id", "chunk_index").agg(F.array_sort(F.collect_list(F.struct("type", "value"))).alias("entities"))
    none = F.array().cast("array<struct<type:string,value:string>>")
    text = F.substring(F.col("text"), F.col("char_start") + 1, F.col("char_end") - F.col("char_start"))
    out = made.join(docs.select("row_id", "text"), "row_id").withColumn("text", text).join(per, ["row_id", "chunk_index"], "left")
    out = out.select(F.struct("row_id", "chunk_index").alias("_order"), "text", F.coalesce("entities", none).alias("entities"))
    jsonl.write_jsonl(out, output_path, order="_order", mode="overwrite")
    return made.count()


def prepare(spark: SparkSession, input_path: str, output_path: str, max_length: int = 512, validation_split: float = 0.1, seed: int = 42) -> None:
    """Token offsets and label ids of each document, cut at ``max_length``, in parts train and valid, as Parquet."""
    docs = load(spark, input_path)
    _stop(review.mention_errors(review.mentions(docs)), input_path)
    found = spans.literal_spans(docs, ROW)
    _stop(spans.cross_type_overlaps(found, ROW), f"{input_path}: overlapping types")
    rows = tokens.token_rows(tokens.tokenize(docs.select("row_id", "text")), "row_id")
    seen = rows.where(F.col("tok_idx") < max_length - tokens.SPECIALS)
    _stop(spans.unaligned(seen, found, ROW, past_end=True), "entities without a token")
    labelled = spans.train_labels(seen, found, ROW).groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("tok_idx", "start", "end", "label_id"))).alias("tokens"))
    evaluate.split(labelled, "row_id", validation_split, seed).write.mode("overwrite").partitionBy("part").parquet(output_path)


def warmup_steps(warmup: float, total: int) -> int:
    """A share of all steps if under 1, else the number itself."""
    if warmup < 0:
        raise ValueError("warm-up must not be negative")
    return int(warmup * total) if warmup < 1 else int(warmup)


def emissions_of(docs: DataFrame, made: DataFrame, emissions: DataFrame | None) -> DataFrame:
    """(row_id, chunk_index, tok_idx, start, end, logits) of the tokens of all windows, from a table or from the rules."""
    if emissions is not None:
        from pyspark.sql import Window

        order = Window.partitionBy("row_id", "chunk_index").orderBy("start", "end")
        return emissions.where("end > start").withColumn("tok_idx", F.row_number().over(order) - 1)
    rows = tokens.token_rows(tokens.tokenize(docs.select("row_id", "text")), "row_id")
    logits = emit.rule_logits(rows, emit.rule_spans(docs, ROW), ROW)
    w = made.select(F.col("row_id").alias("_row"), "chunk_index", "char_start", "char_end")
    return logits.join(w, (F.col("row_id") == F.col("_row")) & (F.col("start") >= F.col("char_start")) & (F.col("end") <= F.col("char_end"))).select("row_id", "chunk_index", "tok_idx", "start", "end", "logits")


def predict(
    docs: DataFrame, emissions: DataFrame | None = None, how: str = "bio_viterbi", aggregate: str = "mean_logits", conf: str = "mean", threshold: float = 0.0, threshold_by_type: dict[str, float] | None = None,
    min_tokens: int = 0, min_tokens_by_type: dict[str, int] | None = None, resolve: bool = True, max_length: int = 512, stride: int = 64, backoff: int = 32,
) -> DataFrame:
    """(row_id, start, end, type, confidence, n_tokens): scored, filtered, merged and resolved spans of documents (row_id, text)."""
    made = tokens.chunks(tokens.tokenize(docs.select("row_id", "text")), "row_id", max_length=max_length, stride=stride, backoff=backoff)
    rows = emissions_of(docs, made, emissions)
    if aggregate == "mean_logits":
        from pyspark.sql import Window

        mean = decode.mean_logits(rows, ["row_id", "start", "end"])
        rows = mean.withColumn("tok_idx", F.row_number().over(Window.partitionBy("row_id").orderBy("start", "end")) - 1)
        keys = ROW
    elif aggregate == "none":
        keys = ["row_id", "chunk_index"]
    else:
        raise ValueError(f"aggregate is 'mean_logits' or 'none', not {aggregate!r}")
    scored = spans.bio_spans_scored(decode.decode(rows, keys, how), keys, conf).drop("chunk_index")
    kept = spans.filter_spans(scored, threshold, min_tokens, threshold_by_type, min_tokens_by_type)
    merged = spans.merge_spans(kept, ROW, scored=True)
    return spans.resolve_overlaps(merged, ROW) if resolve else merged


def infer(
    spark: SparkSession, text: str | None = None, text_file: str | None = None, jsonl_in: str | None = None, jsonl_out: str | None = None, emissions: str | None = None, text_column: str = "text", **how,
) -> str | None:
    """Spans and the decision of one text (as a line of JSON, also to ``jsonl_out``) or of a JSON lines file (to ``jsonl_out``)."""
    kind, value = jsonl.exactly_one(text=text, text_file=text_file, jsonl_in=jsonl_in)
    if kind == "jsonl_in" and jsonl_out in (None, "none"):
        raise ValueError("jsonl_in needs jsonl_out")
    given = spark.read.parquet(emissions) if emissions and emissions != "none" else None
    if kind == "jsonl_in":
        docs = load(spark, value, text_column=text_column, need_entities=False)
    else:
        docs = jsonl.literal_text(spark, value) if kind == "text" else jsonl.read_text(spark, value)
    out = emit.infer_records(docs, predict(docs.select("row_id", "text"), given, **how), ROW)
    if kind != "jsonl_in":
        return jsonl.write_single(out.select("text", "spans", "should_be_public"), jsonl_out)
    keys = [f for f in spark.read.json(value).schema if f.name not in (text_column, "spans", "should_be_public", "_corrupt_record")]
    more = F.from_json("line", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys)) if keys else F.lit(None)
    rows = out.withColumn("_m", more).select("row_id", F.col("text").alias(text_column), *[F.col(f"_m.`{f.name}`").alias(f.name) for f in keys], "spans", "should_be_public")
    jsonl.write_jsonl(rows, jsonl_out, order="row_id", mode="overwrite")
    return None


def evaluate_model(
    spark: SparkSession, dataset: str, emissions: str | None = None, report_path: str = "eval_report.md", max_rows: int = -1, max_chars: int = 200, how: str = "bio_viterbi", text_column: str = "text",
    entities_column: str = "entities", max_length: int = 512, stride: int = 64, backoff: int = 32,
) -> dict:
    """Metrics of predicted against gold labels, logits being averaged over windows, without thresholds; the report goes to ``report_path``."""
    docs = load(spark, dataset, max_rows=max_rows, text_column=text_column, entities_column=entities_column)
    _stop(docs.where(F.btrim("text") == "").select("row_id"), f"{dataset}: empty text")
    _stop(review.mention_errors(review.mentions(docs)), dataset)
    rows = tokens.token_rows(tokens.tokenize(docs.select("row_id", "text")), "row_id")
    gold = spans.gold_spans(docs, ROW)
    made = tokens.chunks(tokens.tokenize(docs.select("row_id", "text")), "row_id", max_length=max_length, stride=stride, backoff=backoff)
    mean = decode.mean_logits(emissions_of(docs, made, spark.read.parquet(emissions) if emissions and emissions != "none" else None), ["row_id", "start", "end"])
    grid, lost = decode.on_grid(mean, rows, ROW)
    _stop(lost, "tokens of windows and of the whole text do not match")
    labels = spans.gold_labels(rows, gold, ROW).select("row_id", "tok_idx", F.col("label_id").alias("gold_id"))
    pairs = decode.decode(grid, ROW, how).select("row_id", "tok_idx", "start", "end", "label", F.col("label_id").alias("pred_id")).join(labels, ["row_id", "tok_idx"])
    flags = evaluate.document_flags(pairs, ROW)
    span = evaluate.span_counts(gold, spans.merge_spans(spans.bio_spans(pairs, ROW), ROW), ROW)
    pii, every = evaluate.binary_counts(flags, "pred_has_pii", "gold_has_pii"), evaluate.binary_counts(flags, "pred_has_entity", "gold_has_entity")
    missed = evaluate.samples(docs, flags, ROW, max_chars).where(evaluate.SAMPLE_LISTS["fn"]).orderBy("row_id")
    report.write(report.render(pii.first().asDict(), every.first().asDict(), missed), report_path)
    return json.loads(evaluate.metrics_json(evaluate.token_counts(pairs), span, pii, every, report_path).first()["json"])


def is_public(spans_column: Column) -> Column:
    """The decision from a column of spans with a type."""
    return ~F.exists(spans_column, lambda s: tax.is_pii(s["type"]))
