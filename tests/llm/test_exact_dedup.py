import hashlib
from collections import defaultdict

import pytest

from velatura.llm.exact_dedup import exact_dedup, exact_groups

from .helpers import ODD, prose, table


def brute(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[t or ""].append(i)
    top = lambda ids: max((i for i in ids if i is not None), default=None)
    return sorted(((i, top(groups[t or ""]), len(groups[t or ""]), i == top(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in rows), key=str)


@pytest.mark.parametrize("max_blocks", [1 << 28, 1024, 16])
def test_groups_against_brute_force(spark, max_blocks):
    rows = ODD + [(i, prose(i % 37, 20), "a") for i in range(300)]
    out = exact_groups(table(spark, rows), max_blocks=max_blocks)
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows)


def test_filter_keeps_one_of_each_text_and_all_columns(spark):
    rows = ODD + [(i, prose(i % 5, 9), "a") for i in range(60)]
    docs = table(spark, rows)
    out = exact_dedup(docs)
    assert out.columns == docs.columns
    kept = out.collect()
    assert sorted((r["text"] or "") for r in kept) == sorted({t or "" for _, t, _ in rows})
    for r in kept:
        assert r["doc_id"] == max((i for i, t, _ in rows if (t or "") == (r["text"] or "") and i is not None), default=None)


def test_empty_table(spark):
    assert exact_groups(table(spark, [])).count() == 0
    assert exact_dedup(table(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = exact_groups(table(spark, ODD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
