import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from velatura.functions import taxonomy as tax
from velatura.operators import decode, emit, evaluate, report, review, spans, tokens

KEY = ["doc_id"]
TOK = "doc_id long, tok_idx int, start int, end int, label string"
SCORED = "doc_id long, start int, end int, type string, confidence double, n_tokens int"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_bio_spans(spark):
    def run(labels, offsets=((0, 1), (2, 4), (4, 6), (7, 9), (10, 11))):
        t = spark.createDataFrame([(1, i, a, b, x) for i, ((a, b), x) in enumerate(zip(offsets, labels))], TOK)
        return rows(spans.bio_spans(t, KEY), "start", "end", "type")

    assert run(["O", "I-X", "I-X", "B-X", "O"]) == [(2, 6, "X"), (7, 9, "X")]
    assert run(["B-X", "BAD", "I-X", "I-Y", "Q-Y"]) == [(0, 6, "X"), (7, 11, "Y")]  # a label without a type is passed over, any prefix continues
    assert run(["B-X", "I-", "I-X", "O", "I-X"]) == [(0, 6, "X"), (10, 11, "X")]
    assert run(["B-X", "I-X", "I-X", "I-X", "I-X"], ((0, 0), (2, 4), (0, 0), (7, 9), (10, 11))) == [(2, 4, "X"), (7, 11, "X")]


def test_scored_spans_close_at_bad_labels(spark):
    t = spark.createDataFrame([(1, i, i * 2, i * 2 + 1, x, p) for i, (x, p) in enumerate([("B-X", 0.5), ("I-X", 0.9), ("BAD", 1.0), ("I-X", 0.7)])], TOK + ", prob double")
    assert rows(spans.bio_spans_scored(t, KEY), "start", "end", "confidence", "n_tokens") == [(0, 3, 0.7, 2), (6, 7, 0.7, 1)]
    assert rows(spans.bio_spans_scored(t, KEY, "min"), "confidence") == [(0.5,), (0.7,)]
    with pytest.raises(ValueError):
        spans.bio_spans_scored(t, KEY, "max")


def test_merge_and_resolve(spark):
    s = spark.createDataFrame([(1, 0, 10, "NOME", 0.8, 2), (1, 8, 14, "NOME", 0.6, 2), (1, 12, 20, "CONTATO", 0.9, 3), (1, 19, 25, "ENDERECO", 0.9, 1), (2, 0, 1, "A", 0.1, 1), (2, 1, 2, "A", 0.2, 1)], SCORED)
    merged = spans.merge_spans(s, KEY, scored=True)
    assert (1, 0, 14, "NOME", 0.8, 4) in rows(merged, *merged.columns)
    assert (2, 0, 2, "A", 0.2, 2) in rows(merged, *merged.columns)  # touching spans merge
    assert rows(spans.resolve_overlaps(merged, KEY).where("doc_id = 1"), "start", "end", "type") == [(12, 20, "CONTATO")]


def test_resolved_spans_are_what_a_loop_keeps(spark):
    r = random.Random(3)
    data = [(d, a, a + r.randrange(1, 9), r.choice("ABC"), r.randrange(4) / 4, 1) for d in range(20) for a in r.sample(range(60), 15)]
    got = rows(spans.resolve_overlaps(spans.merge_spans(spark.createDataFrame(data, SCORED), KEY, scored=True), KEY), "doc_id", "start", "end", "type")
    want = []
    for d in range(20):
        merged = []
        for k in "ABC":
            for _, a, b, _, c, _ in sorted(x for x in data if x[0] == d and x[3] == k):
                if merged and merged[-1][2] == k and a <= merged[-1][1]:
                    merged[-1] = (merged[-1][0], max(b, merged[-1][1]), k, max(c, merged[-1][3]))
                else:
                    merged.append((a, b, k, c))
        kept = []
        for s in sorted(merged):
            if kept and s[0] < kept[-1][1] and s[2] != kept[-1][2]:
                if (s[3], s[1] - s[0]) > (kept[-1][3], kept[-1][1] - kept[-1][0]):
                    kept[-1] = s
            else:
                kept.append(s)
        want += [(d, a, b, k) for a, b, k, _ in kept]
    assert got == sorted(want)


def test_filter(spark):
    s = spark.createDataFrame([(1, 0, 1, "X", 0.7, 1), (1, 2, 3, "X", 0.9, 2)], SCORED)
    assert rows(spans.filter_spans(s, 0.8), "start") == [(2,)]
    assert rows(spans.filter_spans(s, 0.8, threshold_by_type={"X": 0.0}), "start") == [(0,), (2,)]
    assert rows(spans.filter_spans(s, 0.0, 2), "start") == [(2,)]
    assert rows(spans.filter_spans(s, 0.0, 2, None, {"X": 0}), "start") == [(0,), (2,)]


DOCS = "row_id long, text string, entities array<struct<type:string,value:string>>"


def doc(spark, text, *ents):
    return spark.createDataFrame([(1, text, [{"type": k, "value": v} for k, v in ents])], DOCS)


def test_gold_spans(spark):
    d = doc(spark, "Rua João Silva 10", ("NOME_PESSOA", "João Silva"), ("ENDERECO", "Rua João Silva 10"))
    assert rows(spans.gold_spans(d, ["row_id"]), "start", "end", "type") == [(0, 17, "ENDERECO")]
    assert spans.cross_type_overlaps(spans.literal_spans(d, ["row_id"]), ["row_id"]).count() == 1
    d = doc(spark, "CNPJ 25.598.301/0001-68 IMPRENSA NACIONAL", ("ORG_JURIDICA", "25.598.301/0001-68"), ("ORG_JURIDICA", "IMPRENSA NACIONAL"))
    assert rows(spans.gold_spans(d, ["row_id"]), "start", "end", "type") == [(5, 23, "DOC_EMPRESA"), (26, 41, "ORG_JURIDICA")]


def test_labels_of_tokens(spark):
    d = doc(spark, "Rua João Silva 10", ("NOME_PESSOA", "João Silva"))
    t = tokens.token_rows(tokens.tokenize(d), "row_id")
    gold = spans.gold_spans(d, ["row_id"])
    assert [r["label"] for r in spans.gold_labels(t, gold, ["row_id"]).orderBy("tok_idx").collect()] == ["O", "B-NOME_PESSOA", "I-NOME_PESSOA", "O"]
    late = spark.createDataFrame([(1, 50, 60, "CONTATO"), (1, 3, 4, "CONTATO")], "row_id long, start int, end int, type string")
    assert spans.unaligned(t, late, ["row_id"]).count() == 1
    assert spans.unaligned(t, late, ["row_id"], past_end=True).count() == 2 if rows(t.where("start = 3"), "start") == [] else True
    special = t.withColumn("start", F.when(F.col("tok_idx") == 0, 0).otherwise(F.col("start"))).withColumn("end", F.when(F.col("tok_idx") == 0, 0).otherwise(F.col("end")))
    assert spans.gold_labels(special, gold, ["row_id"]).orderBy("tok_idx").first()["label_id"] == tax.IGNORED


# --- windows ------------------------------------------------------------------------------------


def plain_chunks(text, max_length, stride, backoff):
    """A direct reading of the window rules, token by token."""
    starts, ends, _, _ = tokens._arrays(text)
    n, budget = len(starts), max_length - 2
    word = lambda c: c.isalnum() or c in "'’-_"
    edge = lambda p: p <= 0 or p >= len(text) or not (word(text[p - 1]) and word(text[p]))
    if n <= budget:
        return [(0, len(text))]
    out, k = [], 0
    while k * (budget - stride) < n:
        s = k * (budget - stride)
        lim = min(s + budget, n)
        least = max(s + 1, min(lim, s + budget - stride))
        e = lim
        if s + budget - stride < n and lim > least and backoff > 0:
            options = [((30 if text[ends[lim - d - 1] - 1] in ".!?" else 10) - d, -d) for d in range(min(backoff, lim - least - 1) + 1) if edge(ends[lim - d - 1])]
            options = [o for o in options if o[0] >= 0]
            e = lim + max(options)[1] if options else lim
        while e > least and not edge(ends[e - 1]):
            e -= 1
        a = starts[s]
        while a > 0 and word(text[a - 1]):
            a -= 1
        while e > least and e - starts.index(a) > budget:
            e -= 1
        out.append((a, starts[e] if e < n else len(text)))
        if e >= n:
            break
        k += 1
    return out


TEXT = st.text(alphabet="ab1 .-'é\n!", min_size=0, max_size=160)


def test_windows_against_plain_loop(spark):
    r = random.Random(5)
    texts = ["".join(r.choice("abé1 .-'!\n  xyz") for _ in range(r.randrange(0, 300))) for _ in range(150)] + ["", "one", "a-b-c " * 40, "x." * 100, "no-end" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for max_length, stride, backoff in ((16, 4, 32), (20, 8, 5), (16, 0, 32), (40, 37, 32), (24, 10, 0)):
        got = {}
        for c in tokens.chunks(tokens.tokenize(df), "doc_id", max_length=max_length, stride=stride, backoff=backoff).orderBy("doc_id", "chunk_index").collect():
            got.setdefault(c["doc_id"], []).append((c["char_start"], c["char_end"]))
        assert got == {i: plain_chunks(t, max_length, stride, backoff) for i, t in enumerate(texts)}


def test_windows_cover_texts(spark):
    r = random.Random(8)
    texts = [" ".join(r.choice(["word", "long-word", "end.", "it's", "12"]) for _ in range(200)) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    chunks = tokens.chunks(tokens.tokenize(df), "doc_id", max_length=32, stride=8)
    assert chunks.where("not fits").count() == 0
    whole = df.select("doc_id", F.lit(0).alias("start"), F.length("text").alias("end"), F.lit("X").alias("type"))
    assert spans.coverage(whole, chunks, KEY).where("not covered").count() == 0
    assert spans.coverage(whole, chunks.where("chunk_index <> 2"), KEY).where("covered").count() == 0


@settings(max_examples=60, deadline=None)
@given(TEXT)
def test_tokens_partition_what_is_not_space(text):
    starts, ends, flags, origin = tokens._arrays(text)
    assert "".join(text[a:b] for a, b in zip(starts, ends)) == "".join(text.split())
    assert all(o <= i for i, o in enumerate(origin)) and len(flags) == len(starts)


def test_window_arguments():
    assert tokens.check_window(512, 64) == (510, 446)
    for bad in ((8, 0), (20, 18), (20, -1)):
        with pytest.raises(ValueError):
            tokens.check_window(*bad)


# --- decoding -----------------------------------------------------------------------------------


def test_viterbi_against_all_paths():
    labels = ("O", "B-X", "I-X", "B-Y", "I-Y")
    trans = decode.transitions(labels)
    r = np.random.default_rng(1)
    for n in (1, 2, 4):
        em = r.normal(size=(n, 5)).astype(np.float32)
        best = max(np.ndindex(*[5] * n), key=lambda p: float(em[0, p[0]]) + (-1e4 if p[0] in (2, 4) else 0) + sum(float(em[i, p[i]] + trans[p[i - 1], p[i]]) for i in range(1, n)))
        assert decode.viterbi(em, trans, labels) == list(best)
    assert decode.viterbi(np.array([[0, 0, 5], [0, 0, 5]]), decode.transitions(("O", "B-X", "I-X")), ("O", "B-X", "I-X")) == [1, 2]
    assert decode.viterbi(np.zeros((0, 5)), trans, labels) == []
    assert decode.viterbi(np.full((2, 5), 3.0), trans, labels, np.array([True, False]))[0] == 0


def test_no_path_is_illegal():
    r = np.random.default_rng(4)
    trans = decode.transitions()
    for _ in range(20):
        path = decode.viterbi(r.normal(size=(12, 27)), trans)
        assert not tax.LABELS[path[0]].startswith("I-")
        assert all(trans[a, b] == 0 for a, b in zip(path, path[1:]))


def test_softmax_argmax_mean(spark):
    df = spark.createDataFrame([(1, [1.0, 3.0, 3.0]), (1, [3.0, 5.0, 1.0])], "doc_id long, logits array<double>")
    r = df.select(decode.argmax(F.col("logits")).alias("a"), decode.softmax(F.col("logits")).alias("s")).first()
    assert r["a"] == 1 and math.isclose(sum(r["s"]), 1) and math.isclose(r["s"][1], r["s"][2])
    assert decode.mean_logits(df, KEY).first()["logits"] == [2.0, 4.0, 2.0]


def test_rule_pipeline_end_to_end(spark):
    text = "O CPF do solicitante João Silva é 123.456.789-00."
    d = spark.createDataFrame([(1, text), (2, "Encaminho o processo SEI 001.002.003/2024."), (3, "Nada."), (4, None)], "doc_id long, text string")
    found = emit.rule_spans(d, KEY)
    assert rows(found, "doc_id", "start", "end", "type") == [(1, 34, 48, "DOC_PESSOAL"), (2, 25, 41, "ID_PROCESSUAL")]
    t = tokens.token_rows(tokens.tokenize(d), "doc_id")
    labelled = decode.decode(emit.rule_logits(t, found, KEY), KEY)
    scored = spans.resolve_overlaps(spans.merge_spans(spans.bio_spans_scored(labelled, KEY), KEY, scored=True), KEY)
    assert rows(scored, "doc_id", "start", "end", "type") == rows(found, "doc_id", "start", "end", "type")
    out = {r["doc_id"]: r for r in emit.infer_records(d, scored, KEY).collect()}
    assert out[1]["spans"][0]["value"] == "123.456.789-00" and not out[1]["should_be_public"] and out[3]["should_be_public"]
    assert {r["doc_id"]: r["should_be_public"] for r in emit.publish_decision(d, found, KEY).collect()} == {1: False, 2: False, 3: True, 4: True}


def test_external_emitter(spark):
    def model(texts):
        return [[(0, len(t), [float(len(t))] * 27)] for t in texts]

    c = spark.createDataFrame([(1, 0, 10, "abc"), (1, 1, 20, "de")], "doc_id long, chunk_index int, char_start int, text string")
    assert rows(emit.external(c, model, KEY), "chunk_index", "start", "end") == [(0, 10, 13), (1, 20, 22)]


# --- review and evaluation ------------------------------------------------------------------------


def test_review(spark):
    d = doc(spark, "CGU e CGU e Silva", ("ORG_JURIDICA", "CGU"), ("ORG_JURIDICA", "CGU"), ("ORG_JURIDICA", "Silva"), ("NOME_PESSOA", "Silva"))
    table = spark.createDataFrame([("ORG_JURIDICA", "CGU", 0, 0), ("CONTATO", "e", 1, 0)], "type string, value string, label_ord int, value_ord int")
    got = [tuple(e) for e in review.apply_review(d, table, add_missing=True).first()["entities"]]
    assert got == [("ORG_JURIDICA", "CGU"), ("ORG_JURIDICA", "CGU"), ("NOME_PESSOA", "Silva"), ("CONTATO", "e")]  # repeats stay, unknown labels stay, additions follow
    assert rows(review.missing_labels(review.mentions(d), table), "type") == [("NOME_PESSOA",)]
    assert rows(review.value_type_conflicts(review.mentions(d), ["row_id"]), "value", "n_types") == [("Silva", 2)]
    bad = review.mention_errors(review.mentions(doc(spark, "x", ("NOPE", "x"), ("CONTATO", "y"), ("CONTATO", " "), ("CONTATO", "x"))), check_format=True)
    assert rows(bad, "ent_idx", "error") == [(0, "unknown_type"), (1, "not_in_text"), (2, "empty"), (3, "phone_digits")]


def test_metrics(spark):
    zero = spark.createDataFrame([(0, 0, 3)], "tp long, pred_pos long, true_pos long")
    assert rows(evaluate.with_prf(zero), "precision", "recall", "f1") == [(0.0, 0.0, 0.0)]
    flags = spark.createDataFrame([(True, True)] * 8 + [(False, False)] + [(True, False)] * 2 + [(False, True)], "p boolean, g boolean")
    m = evaluate.binary_counts(flags, "p", "g").first()
    assert (m["precision"], m["recall"], m["accuracy"]) == (0.8, 8 / 9, 0.75)
    assert evaluate.binary_counts(flags.where("false"), "p", "g").first()["accuracy"] == 0.0
    assert {r["tp"] for r in evaluate.token_counts(evaluate.empty_pairs(spark)).collect()} == {0}
    one = evaluate.split(spark.range(5000).withColumnRenamed("id", "doc_id"), "doc_id")
    assert 400 < one.where("part = 'valid'").count() < 600


def test_report():
    class Missed:
        def toLocalIterator(self):
            return iter([])

    m = {"tp": 1200, "tn": 1, "fp": 2, "fn": 0, "precision": 0.5, "recall": 1.0, "f1": 2 / 3, "accuracy": 0.75}
    text = report.render(m, m, Missed())
    assert text.startswith("# Relatório") and text.endswith("_None_\n") and "| contém PII | 1.200 | 0 |" in text and "0.6667 (66.67%)" in text
    assert report.grid({"a|b": report.RIGHT}, [("x\ny",)]) == "| a\\|b |\n| ---: |\n| x y |\n"
    made = Row(row_id=4, excerpt=" <b> ", entities=[Row(type="CONTATO", value="a@b")], pii_bucket="fn", entity_bucket="tp", gold_should_be_public=False, pred_should_be_public=True, pii_token_error=True, entity_token_error=False)
    block = report.sample(made)
    assert block.startswith("<details>\n<summary>linha=5 | doc (PII)=falso negativo |") and "— &lt;b&gt;</summary>\n\n- **linha" in block
    assert "`False`\n\n**trecho (excerpt)**:\n\n> <b>\n\n**entidades (entities)**:\n\n```json\n[\n" in block and block.endswith("```\n\n</details>\n")
    bare = report.sample(Row(**(made.asDict() | {"excerpt": "", "entities": []})))
    assert bare.endswith("erro em tokens (qualquer entidade)**: `False`\n\n</details>\n")
    assert [x.split("\n")[0] for x in report.samples("T", iter([made] * 3), 3, 2)] == ["## T (n=3)", "_Showing first 2 of 3 samples._", "<details>", "<details>"]
