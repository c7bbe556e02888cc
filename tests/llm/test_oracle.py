import os

import pytest

from velatura.llm.queries import ORACLE, QUERIES

from ..oracle import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, tmp_path, name):
    compare(spark, SF, QUERIES[name], ORACLE[name], str(tmp_path / "out"))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows(spark, name):
    df = QUERIES[name](spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert df.select("doc_id").distinct().count() == n
    assert df.count() == n or name == "op9_packing"
