import json
import os

import pytest
from pyspark.sql import functions as F

from velatura.sources import jsonl
from velatura.streaming import publish


def test_tolerant_and_strict_lines(spark, tmp_path):
    path = str(tmp_path / "a.jsonl")
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"text": "ção", "entities": [], "extra": 1}\n\n[1]\n{bad\n{"text": null}\n')
    got = [tuple(r) for r in jsonl.read_documents(spark, path).select("line_no", "text", "problem").orderBy("line_no").collect()]
    assert got == [(1, "ção", None), (3, None, "no_object"), (4, None, "bad_json"), (5, None, None)]
    assert jsonl.read_documents(spark, path, blank="error").where("problem = 'blank'").count() == 1
    with pytest.raises(Exception, match="line [0-9]: "):
        jsonl.read_documents(spark, path, strict=True).collect()


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", None), (1, "ã\n", "k")], "row_id long, text string, extra string")
    jsonl.write_jsonl(df, str(tmp_path / "o"), order="row_id")
    lines = [x for p in sorted(os.listdir(tmp_path / "o")) if p.startswith("part") for x in open(tmp_path / "o" / p, encoding="utf-8").read().splitlines()]
    assert [json.loads(x) for x in lines] == [{"text": "ã\n", "extra": "k"}, {"text": "b", "extra": None}]
    assert json.loads(jsonl.write_single(df.where("row_id = 2"), str(tmp_path / "one.json")))["text"] == "b"
    assert open(tmp_path / "one.json").read().endswith("\n")


def test_review_dictionary(spark, tmp_path):
    table = spark.createDataFrame([("CONTATO", "b", 0, 0), ("CONTATO", "a", 0, 1), ("NOME_PESSOA", "Zé", 1, 0)], "type string, value string, label_ord int, value_ord int")
    path = str(tmp_path / "r.json")
    jsonl.write_review(table, path)
    assert open(path, encoding="utf-8").read() == json.dumps({"CONTATO": ["b", "a"], "NOME_PESSOA": ["Zé"]}, ensure_ascii=False, indent=2) + "\n"
    assert sorted(map(tuple, jsonl.read_review(spark, path).collect())) == sorted(map(tuple, table.collect()))
    for bad in ({"NOPE": ["x"]}, {"CONTATO": [" x"]}, {"CONTATO": [""]}):
        with open(path, "w") as f:
            json.dump(bad, f)
        with pytest.raises(Exception, match="review:"):
            jsonl.read_review(spark, path).collect()
    with open(path, "w") as f:
        json.dump({"CONTATO": ["x", "x", "y"]}, f)
    assert jsonl.read_review(spark, path).count() == 2


def test_texts_and_arguments(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text("um\ndois", encoding="utf-8")
    assert jsonl.read_text(spark, str(path)).first()["text"] == "um\ndois"
    assert jsonl.literal_text(spark, "x").first()["text"] == "x"
    assert jsonl.exactly_one(text="none", text_file=None, jsonl_in="p") == ("jsonl_in", "p")
    for given in ({"a": None, "b": "none"}, {"a": "1", "b": "2"}):
        with pytest.raises(ValueError):
            jsonl.exactly_one(**given)
    assert jsonl.thresholds("none") == {} and jsonl.thresholds('{"A": 1}') == {"A": 1.0} and jsonl.thresholds('{"A": true}', int) == {"A": 1}
    for bad in ("[1]", '{"A": "x"}'):
        with pytest.raises(ValueError):
            jsonl.thresholds(bad)
    with pytest.raises(ValueError):
        jsonl.thresholds('{"A": 1.5}', int)


def test_violations(spark):
    rows = [(1, "", []), (2, "a@b.com x", [("CONTATO", "a@b.com"), ("NOPE", "x"), ("CONTATO", "zz"), ("CONTATO", " ")]), (3, "Silva", [("NOME_PESSOA", "Silva"), ("ORG_JURIDICA", "Silva")]), (4, "t", None)]
    d = spark.createDataFrame([(i, t, None if e is None else [{"type": k, "value": v} for k, v in e]) for i, t, e in rows], "row_id long, text string, entities array<struct<type:string,value:string>>")
    got = sorted(tuple(r) for r in jsonl.schema_violations(d).collect())
    assert got == [(1, -1, "empty_text"), (2, 1, "unknown_type"), (2, 2, "not_in_text"), (2, 3, "empty"), (3, 0, "two_types"), (3, 1, "format:surname"), (4, -1, "no_entities")]


def test_publish_folder(tmp_path):
    (tmp_path / "new").mkdir()
    (tmp_path / "new" / "f").write_text("2")
    (tmp_path / "best").mkdir()
    (tmp_path / "best" / "f").write_text("1")
    jsonl.publish_folder(str(tmp_path / "new"), str(tmp_path / "best"))
    assert os.listdir(tmp_path) == ["best"] and (tmp_path / "best" / "f").read_text() == "2"


def test_stream(spark, tmp_path):
    spark.createDataFrame([(1, "mail a@b.com"), (2, "nothing")], "doc_id long, text string").write.json(str(tmp_path / "in"))
    publish.write_stream(publish.read_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.json(str(tmp_path / "out"))
    assert {r["doc_id"]: r["should_be_public"] for r in got.collect()} == {1: False, 2: True}
    assert publish.decided(spark.createDataFrame([(1, None)], "doc_id long, text string")).select(F.col("should_be_public")).first()[0]
