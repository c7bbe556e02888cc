import glob
import json

import pytest

from velatura.__main__ import main
from velatura.plans import programs

DOCS = [
    {"text": "O CPF de João Silva é CPF: 123.456.789-00.", "entities": [{"type": "NOME_PESSOA", "value": "João Silva"}, {"type": "DOC_PESSOAL", "value": "CPF: 123.456.789-00"}], "id": "a"},
    {"text": "Mande a ana@exemplo.org, CGU. João Silva.", "entities": [{"type": "CONTATO", "value": "ana@exemplo.org"}, {"type": "ORG_JURIDICA", "value": "CGU"}], "id": "b"},
    {"text": "Nada.", "entities": [], "id": "c"},
]


@pytest.fixture
def file(tmp_path):
    def write(rows, name="in.jsonl"):
        path = tmp_path / name
        path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), encoding="utf-8")
        return str(path)

    return write


def lines(folder):
    return [json.loads(x) for p in sorted(glob.glob(f"{folder}/part-*")) for x in open(p, encoding="utf-8").read().splitlines()]


def test_extract_and_apply(spark, file, tmp_path):
    path, out = file(DOCS), str(tmp_path / "r.json")
    assert main(["extract", "--input", path, "--output", out, "--normalize"], spark) == 0
    found = json.load(open(out, encoding="utf-8"))
    assert list(found) == ["NOME_PESSOA", "DOC_PESSOAL", "CONTATO", "ORG_JURIDICA"] and found["DOC_PESSOAL"] == ["123.456.789-00"]
    del found["CONTATO"]
    found["ORG_JURIDICA"] = []
    json.dump(found, open(out, "w", encoding="utf-8"), ensure_ascii=False)
    main(["apply", "--input", path, "--review", out, "--output", str(tmp_path / "o"), "--normalize", "--add-missing"], spark)
    got = lines(tmp_path / "o")
    assert [r["id"] for r in got] == ["a", "b", "c"]
    assert [(e["type"], e["value"]) for e in got[1]["entities"]] == [("CONTATO", "ana@exemplo.org"), ("ORG_JURIDICA", "CGU"), ("NOME_PESSOA", "João Silva")] or [
        (e["type"], e["value"]) for e in got[1]["entities"]
    ] == [("CONTATO", "ana@exemplo.org"), ("NOME_PESSOA", "João Silva")]
    with pytest.raises(ValueError, match="labels missing"):
        programs.apply(spark, path, out, str(tmp_path / "x"), normalize=True, require_all_labels=True)


def test_chunk(spark, file, tmp_path):
    rows = [{"text": "Ana mora. " * 30 + "Fale com ana@exemplo.org já.", "entities": [{"type": "CONTATO", "value": "ana@exemplo.org"}]}, DOCS[2]]
    n = programs.chunk(spark, file(rows), str(tmp_path / "o"), max_length=24, stride=8)
    got = lines(tmp_path / "o")
    assert len(got) == n and got[-1] == {"text": "Nada.", "entities": []}
    assert {"type": "CONTATO", "value": "ana@exemplo.org"} in [e for r in got for e in r["entities"]]
    with pytest.raises(ValueError, match="overlapping types"):
        bad = {"text": "Rua João Silva 10", "entities": [{"type": "NOME_PESSOA", "value": "João Silva"}, {"type": "ENDERECO", "value": "Rua João Silva 10"}]}
        programs.chunk(spark, file([bad], "bad.jsonl"), str(tmp_path / "b"))
    with pytest.raises(ValueError, match="format:prefix"):
        programs.chunk(spark, file(DOCS), str(tmp_path / "b"))


def test_prepare(spark, file, tmp_path):
    programs.prepare(spark, file(DOCS), str(tmp_path / "o"), validation_split=0.5)
    got = spark.read.parquet(str(tmp_path / "o"))
    assert got.count() == 3 and set(got.columns) == {"row_id", "tokens", "part"}
    labels = [t["label_id"] for t in got.where("row_id = 0").first()["tokens"]]
    assert labels[3:5] == [1, 2] and labels[0] == 0
    assert programs.warmup_steps(0.1, 55) == 5 and programs.warmup_steps(7, 55) == 7


@pytest.mark.parametrize("aggregate", ["mean_logits", "none"])
def test_infer(spark, file, tmp_path, capsys, aggregate):
    main(["infer", "--text", "CPF 123.456.789-00", "--aggregate_overlaps", aggregate], spark)
    got = json.loads(capsys.readouterr().out)
    assert got["should_be_public"] is False and got["spans"][0]["value"] == "123.456.789-00"
    main(["infer", "--jsonl_in", file(DOCS), "--jsonl_out", str(tmp_path / "o"), "--aggregate_overlaps", aggregate], spark)
    out = lines(tmp_path / "o")
    assert [(r["id"], r["should_be_public"]) for r in out] == [("a", False), ("b", False), ("c", True)]
    assert [s["type"] for s in out[1]["spans"]] == ["CONTATO"]
    with pytest.raises(ValueError):
        programs.infer(spark, text="x", text_file="y")
    with pytest.raises(ValueError):
        programs.infer(spark, jsonl_in="x")


def test_eval(spark, file, tmp_path, capsys):
    report = str(tmp_path / "report.md")
    main(["eval", "--dataset_path", file(DOCS), "--report_path", report], spark)
    got = json.loads(capsys.readouterr().out)
    assert got["pii_binary"]["tp"] == 2 and got["pii_binary"]["tn"] == 1 and got["pii_p1"] == 1.0
    assert got["per_type_span_level"]["CONTATO"]["tp"] == 1 and got["per_type_span_level"]["NOME_PESSOA"]["recall"] == 0.0
    assert "total de linhas avaliadas | 3" in open(report, encoding="utf-8").read()


def test_bad_input_stops(spark, file, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"text": "a", "entities": []}\n\n', encoding="utf-8")
    assert programs.load(spark, str(path)).count() == 1
    with pytest.raises(ValueError, match="blank"):
        programs.extract(spark, str(path), str(tmp_path / "o"))
    with pytest.raises(ValueError, match="legacy"):
        programs.load(spark, file([{"text": "a", "pii_candidate": "x"}]))
    with pytest.raises(ValueError, match="no entities"):
        programs.load(spark, file([{"text": "a"}]))
