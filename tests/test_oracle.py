import os

import pytest

from velatura.plans.queries import ORACLE, QUERIES

from .oracle import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tmp_path, name):
    if name in ORACLE:
        compare(spark, SF, QUERIES[name], ORACLE[name], str(tmp_path / "out"))
    else:
        assert QUERIES[name](spark, SF).count() == 1


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
