import hashlib
import math
import re
from collections import Counter

import pytest

from velatura.llm.mixing import GOLDEN, mix, mix_plan, schedule, source_targets

from .helpers import ODD, prose, table


def fill(sizes: dict, share=1.5, cap=2.0):
    """Targets by pouring the excess round after round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, target, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > cap * sizes[s] + 1e-9]
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
        left -= sum(cap * sizes[s] for s in over)
        open_ -= set(over)
    return target


def test_targets_against_pouring(spark):
    sizes = {"a": 1000, "b": 10, "c": 500, "ä": 3, "Z": 800, None: 70, "zero": 0}
    out = source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long"))
    want = fill(sizes)
    for r in out.collect():
        assert r["target"] == pytest.approx(want[r["source"]])


def rows():
    out = list(ODD)
    for i in range(400):
        s = "hot" if i % 3 == 0 else f"s{i % 7}"
        out.append((i, prose(i, 5 + i % 90), s))
    return out


@pytest.mark.parametrize("block", [4, 4096])
def test_plan(spark, block):
    data = rows()
    docs = table(spark, data)
    plan = mix_plan(docs, block_words=block)
    got = plan.collect()
    assert len(got) == len(data)
    words = sorted((i if i is not None else -1, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _ in data)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"]) for r in got) == words
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    by = {}
    source = {(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))): s for i, t, s in data}
    for r in got:
        k = source[(r["doc_id"], r["size"])]
        taken, _ = by.get(k, (0, 0))
        by[k] = (taken + r["taken"], r["target"])
    for taken, target in by.values():
        assert abs(taken - target) <= max(3.0, 0.01 * target)
    assert sorted(map(tuple, mix_plan(docs, block_words=block).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_plan_against_slots_one_by_one(spark):
    """The schedule played slot by slot: words drawn from a source's shuffled text, block after block."""
    data = [r for r in rows() if r[0] is not None]
    got = {(r["doc_id"], r["size"]): (r["taken"], r["first_slot"]) for r in mix_plan(table(spark, data), block_words=40, least=8).collect()}
    words = {}
    for i, t, s in data:
        h = int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16)
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        words.setdefault(s, []).append((h % 4096, h, i, n))
    laid = {s: [(i, n) for _, _, i, n in sorted(v) for _ in range(n)] for s, v in words.items()}
    sizes = {s: len(v) for s, v in laid.items()}
    target = fill(sizes)
    blocks = {s: max(-(-n // 40), min(n, 8)) for s, n in sizes.items() if n}
    order = sorted(blocks, key=lambda s: ("s" + s).encode() if s is not None else b"")
    quota = [target[s] / sizes[s] * blocks[s] for s in order]
    high = [sum(quota[: k + 1]) / sum(quota) for k in range(len(order))]
    taken, first, rank = {}, {}, dict.fromkeys(order, 0)
    for slot in range(math.ceil(sum(quota) - 1e-6)):
        x = slot * GOLDEN % 1.0
        s = order[next((k for k, h in enumerate(high) if x < h), len(order) - 1)]
        r, rank[s] = rank[s], rank[s] + 1
        if r < 2 * blocks[s]:
            b = r % blocks[s]
            for doc in laid[s][b * sizes[s] // blocks[s] : (b + 1) * sizes[s] // blocks[s]]:
                taken[doc] = taken.get(doc, 0) + 1
                first.setdefault(doc, slot)
    assert len(first) > 300
    same = {(i, n): k for (i, n), k in Counter((i, n) for v in words.values() for _, _, i, n in v).items()}
    for doc, k in same.items():
        if k == 1:
            assert got[doc] == (taken.get(doc, 0), first.get(doc)), doc


def test_another_sequence_gives_another_mix(spark):
    docs = table(spark, rows())
    plans = [sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in mix_plan(docs, golden=g).collect()) for g in (GOLDEN, 0.0, math.sqrt(2) - 1)]
    assert plans[0] != plans[1] and plans[0] != plans[2]


def test_schedule_is_spread_evenly(spark):
    quotas = spark.createDataFrame([("a", 0.0, 0.75, False), ("b", 0.75, 1.0, True)], "_source string, _low double, _high double, _last boolean")
    got = schedule(quotas, 10_000).collect()
    assert sorted(r["_slot"] for r in got) == list(range(10_000))
    for s, share in (("a", 0.75), ("b", 0.25)):
        own = sorted((r["_slot"], r["_rank"]) for r in got if r["_source"] == s)
        assert [k for _, k in own] == list(range(len(own)))
        assert all(abs(k - share * slot) <= 4 for slot, k in own)  # evenly in every stretch of the mix


def test_mix_repeats_and_cuts(spark):
    docs = table(spark, [r for r in rows() if r[0] is not None and r[0] < 800])
    plan = {r["doc_id"]: r for r in mix_plan(docs).collect()}
    out = mix(docs)
    assert out.columns == docs.columns
    taken = {}
    for r in out.collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    assert all(taken.get(i, 0) == r["taken"] for i, r in plan.items())


def test_mix_comes_in_the_order_of_its_slots(spark):
    docs = table(spark, [r for r in rows() if r[0] is not None and r[0] < 800])
    slot = {r["doc_id"]: r["first_slot"] for r in mix_plan(docs).collect()}
    met, order = set(), []
    for r in mix(docs, lot_words=2000).collect():
        if r["doc_id"] not in met:
            met.add(r["doc_id"])
            order.append(slot[r["doc_id"]])
    later = sum(a > b for a, b in zip(order, order[1:]))
    assert len(order) > 300 and later < 0.1 * len(order)  # a document may begin in one block and be met first in the next


def test_repeated_ids_stay_within_twice_their_size(spark):
    data = [(1, " ".join(f"w{k}" for k in range(10)), "a"), (1, "z", "a"), (1, "z", "a"), (None, "p q r", "a"), (None, "p q", "a"), *[(i, prose(i, 30), "b") for i in range(2, 60)]]
    taken = Counter()
    for r in mix(table(spark, data)).collect():
        for w in (r["text"] or "").split():
            taken[(r["doc_id"], w)] += 1
    assert all(taken[(1, f"w{k}")] <= 2 for k in range(10)) and taken[(1, "z")] <= 4 and taken[(None, "p")] <= 4 and taken[(None, "r")] <= 2


def test_odd_rows_and_empty_table(spark):
    out = mix(table(spark, ODD))
    assert out.where("text is null").count() == 1  # a document without words is passed on
    assert mix_plan(table(spark, [])).count() == 0
    assert mix(table(spark, [])).count() == 0
    assert "Python" not in mix_plan(table(spark, ODD))._jdf.queryExecution().toString()
