import pytest

import corpus_pipeline as cp
from velatura.llm.queries import ORACLE, QUERIES

from .helpers import SCHEMA, prose

WORDS = tuple(f"{a}{b}" for a in ("la", "mo", "ri", "te", "su", "pha", "gri", "do") for b in ("ne", "ra", "sti", "lo", "mand", "th", "ved"))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    rows, labels = [], []
    for i in range(240):
        bad = i % 6 == 0
        t = prose(i, 120, WORDS)
        rows.append((i, " | ".join(t.upper().split()) + " !!" if bad else t, "en", f"s{i % 5}", len(t)))
        labels.append((i, int(not bad), 0))
    rows += [(1000 + i, rows[i][1], "en", "copy", 1) for i in range(1, 40)]
    rows += [(2000 + i, rows[i][1] + " end", "en", "near", 1) for i in range(41, 60)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d), rows


def test_stages(spark, folder, tmp_path):
    d, rows = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, d).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(cp.STAGES) - 1:
            assert docs.columns == columns
        seen.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    good = {i for i, *_ in rows if i >= 240 or i % 6}
    good -= {1000 + i for i in range(1, 40) if i % 6 == 0} | {2000 + i for i in range(41, 60) if i % 6 == 0}
    assert seen[0] == good
    texts = {}
    for i, t, *_ in rows:
        if i in good:
            texts[t] = max(i, texts.get(t, -1))
    assert seen[1] == set(texts.values())
    assert seen[1] - seen[2] == {2000 + i for i in range(41, 60) if i % 6}
    assert seen[3] <= seen[2] and seen[4] == seen[3]


def test_run_equals_its_stages_in_a_second_run(spark, folder):
    d, _ = folder
    a, b = cp.run(spark, d), cp.run(spark, d)
    size = lambda df: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert size(a) == size(b)


def test_all_ten_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(ORACLE) <= set(QUERIES)
