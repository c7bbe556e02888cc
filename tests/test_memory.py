"""What a worker or a task holds at once does not grow with the table."""

import json
import os
import random
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from velatura.functions import taxonomy as tax
from velatura.operators import evaluate, spans, tokens
from velatura.plans import queries


def test_token_arrays_leave_in_bounded_batches():
    made = [(np.arange(n, dtype=np.int32),) * 4 for n in [tokens.BATCH_TOKENS // 4] * 9 + [0, 3]]
    sizes = []

    def texts():
        for x in made:
            sizes.append(len(x[0]))
            yield x

    ends, out = [], []
    for batch in tokens.in_lists(texts(), ["starts", "ends", "flags", "origin"]):
        ends.append(len(sizes))  # texts looked at before this batch was given
        out += batch.to_pylist()
    assert ends == [4, 8, 11]  # not all texts first
    assert [len(x["starts"]) for x in out] == sizes and out[-1] == dict.fromkeys(("starts", "ends", "flags", "origin"), [0, 1, 2])


def test_texts_reach_python_in_small_batches(spark):
    rows = tokens.tokenize(spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text")).coalesce(1))

    @F.arrow_udf("long")
    def size(x: pa.Array) -> pa.Array:
        return pa.array([len(x)] * len(x), pa.int64())

    assert rows.select(size("doc_id").alias("n")).agg(F.max("n")).first()[0] <= 512
    assert rows.where("size(starts) <> 2").count() == 0


def test_offsets_of_one_text_are_four_bytes_each():
    starts, ends = tokens.offsets("ab " * 5000)
    assert starts.dtype == ends.dtype == np.int32 and len(starts) == 5000
    assert starts[1] == 3 and ends[1] == 5


def _documents(spark):
    ents = [("NOME_PESSOA", "ana li"), ("CONTATO", "li s"), ("ORG_JURIDICA", "x")]
    texts = ["ana lisa x ana li", "", None, "x-x ana li s " * 40, "nothing"]
    rows = [(i, t, [{"type": k, "value": v} for k, v in ents]) for i, t in enumerate(texts)] + [(None, "ana li", [{"type": "CONTATO", "value": "ana"}])]
    return spark.createDataFrame(rows, "row_id long, text string, entities array<struct<type:string,value:string>>")


def test_gold_tokens_are_labelled_within_their_rows(spark):
    docs, key = _documents(spark), ["row_id"]
    made = spans.gold_token_rows(docs, key)
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    want = spans.gold_labels(tokens.token_rows(tokens.tokenize(docs), "row_id"), spans.gold_spans(docs, key), key)
    columns = ["row_id", "tok_idx", "start", "end", "label_id"]
    order = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(tuple, made.select(columns).collect()), key=order) == sorted(map(tuple, want.select(columns).collect()), key=order)
    before = {(r["row_id"], r["tok_idx"]): r["label_id"] for r in made.collect()}
    assert all(r["id_before"] == before.get((r["row_id"], r["tok_idx"] - 1), 0) for r in made.collect())


def test_spans_from_known_labels_before(spark):
    r = random.Random(2)
    ids = [[r.choice([0, 0, 1, 2, 3, 4]) for _ in range(60)] for _ in range(8)]
    data = [(d, i, 2 * i, 2 * i + 1, x, xs[i - 1] if i else 0) for d, xs in enumerate(ids) for i, x in enumerate(xs)]
    t = spark.createDataFrame(data, "row_id long, tok_idx int, start int, end int, id int, before int")
    # without the token at the very beginning, whose offsets are no special token's
    t = t.withColumn("start", F.col("start") + 1).withColumn("end", F.col("end") + 1)
    want = spans.bio_spans(t.withColumn("label", tax.id_to_label(F.col("id"))), ["row_id"])
    got = spans.bio_spans_known(t, ["row_id"], "id", "before")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_metrics_are_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def watched(x):
        seen.add(1)
        return x

    counts = "pred_pos long, true_pos long, tp long"
    token = spark.createDataFrame([("pii", 2, 2, 1), ("all", 3, 3, 2)], f"scope string, {counts}").withColumn("tp", watched("tp"))
    span = spark.createDataFrame([("PII", 2, 2, 1), ("ALL", 2, 2, 1), ("CONTATO", 2, 2, 1)], f"type string, {counts}").withColumn("tp", watched("tp"))
    flags = spark.createDataFrame([(True, True), (False, True)], "p boolean, g boolean")
    binary = evaluate.binary_counts(flags, "p", "g").withColumn("tp", watched("tp"))
    made = json.loads(evaluate.metrics_json(token, span, binary, binary, "r").first()["json"])
    assert made["pii_binary"]["fn"] == 1 and made["per_type_span_level"]["CONTATO"]["tp"] == 1 and made["all_entities_token_level"]["f1"] == 2 / 3
    assert seen.value == 7  # each row of each table


def test_samples_join_excerpts_and_not_whole_texts(spark):
    docs = spark.createDataFrame([(1, "word " * 5000, [])], "row_id long, text string, entities array<struct<type:string,value:string>>").repartition(2)
    flags = spark.createDataFrame([(1, False, True, False, True, True, True)], "row_id long, pred_has_pii boolean, gold_has_pii boolean, pred_has_entity boolean, gold_has_entity boolean, pii_token_error boolean, entity_token_error boolean")
    made = evaluate.samples(docs, flags.hint("merge"), ["row_id"])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" in plan[plan.index("Join") :] and "regexp_replace" not in plan[: plan.index("Join")]
    assert len(made.first()["excerpt"]) == 200


def test_resolving_does_not_copy_all_kept_spans_at_each(spark):
    """Lists of any length, and long ones in a time that grows little faster than they do."""
    scored = "doc_id long, start int, end int, type string, confidence double, n_tokens int"
    r = random.Random(4)
    data = [(n, a, a + r.randrange(1, 12), r.choice("ABC"), r.randrange(4) / 4, 1) for n in range(1, 40) for a in r.sample(range(3 * n), n)]
    want = []
    for n in range(1, 40):
        kept = []
        for s in sorted(x for x in data if x[0] == n):
            if kept and s[1] < kept[-1][2] and s[3] != kept[-1][3]:
                if (s[4], s[2] - s[1]) > (kept[-1][4], kept[-1][2] - kept[-1][1]):
                    kept[-1] = s
            else:
                kept.append(s)
        want += kept
    assert sorted(map(tuple, spans.resolve_overlaps(spark.createDataFrame(data, scored), ["doc_id"]).collect())) == sorted(want)

    def seconds(n):
        rows = spark.range(n).selectExpr("1L doc_id", "cast(id * 2 as int) start", "cast(id * 2 + 1 as int) end", "'A' type", "0.5D confidence", "1 n_tokens")
        began = time.time()
        assert spans.resolve_overlaps(rows, ["doc_id"]).count() == n
        return time.time() - began

    seconds(1000)
    assert seconds(60_000) < 3 + 8 * seconds(15_000)  # 16 times as long where each step copies all before it


def test_lines_of_many_files_are_numbered_as_of_one(spark, tmp_path, monkeypatch):
    texts = [(i, None if i % 9 == 4 else f"t{i}") for i in range(400)]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(7).write.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would make one part of so few rows
    try:
        path = queries._jsonl_file(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [p for p in os.listdir(path.removeprefix("file:")) if p.startswith("part")]
    assert len(parts) > 1  # no task writes or reads all of them
    monkeypatch.setattr(queries, "_jsonl_file", lambda spark, d: path)
    got = {r["line_no"]: (r["text"], r["problem"]) for r in queries.jsonl_strict_scan(spark, str(tmp_path)).collect()}
    assert sorted(got) == list(range(1, 401))
    assert all(got[i + 1][0] == t for i, t in texts if got[i + 1][1] is None) and got[6][1] == "blank"
    fewer = {r["line_no"]: (r["text"], r["problem"]) for r in queries.jsonl_scan(spark, str(tmp_path)).collect()}
    assert fewer == {k: v for k, v in got.items() if v[1] != "blank"}
