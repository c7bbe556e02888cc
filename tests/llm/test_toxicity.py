import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from velatura.llm import toxicity
from velatura.llm.common import fold

from .helpers import ODD, prose, table

BAD = ("blorp", "snark", "gunk")


def corpus(n=400):
    rows, labels = [], []
    for i in range(n):
        bad = i % 7 == 0
        t = prose(i, 60)
        rows.append((i, t.replace("river", BAD[i % 3], 2) + (f". {BAD[i % 3].upper()}!!" if bad else "") if bad else t, "a"))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_scores_tell_toxic_from_clean(spark):
    rows, labels = corpus()
    docs = table(spark, rows + ODD)
    held = fold("doc_id", 5) == 0
    index = toxicity.fit(docs, spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None), (10**9, 1, 1)], "doc_id long, quality int, toxic int"), "toxic", ~held)
    out = toxicity.score(docs, index).withColumn("held", held).collect()
    assert len(out) == len(rows) + len(ODD)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    for r in out:
        if r["held"] and r["doc_id"] is not None and r["doc_id"] < 400:
            assert r["predicted"] == (r["doc_id"] % 7 == 0)
    assert any(r["evidence"] for r in out if r["predicted"])


def test_block_max_search_is_exact():
    r = np.random.default_rng(2)
    # weights of many sizes, so that blocks are left out, and repeats, so that there are ties
    examples = [(i, int(i % 9 == 0), {f"w{t}".encode(): int(n) for t, n in zip(r.zipf(1.3, 8) % 400, r.integers(1, 9, 8))}) for i in range(1500)]
    examples += [(2000 + i, y, c) for i, y, c in examples[:40]]
    index = toxicity.Index((i, y, list(c), list(c.values())) for i, y, c in examples)
    docs = {i: c for i, _, c in examples}
    n = Counter(t for c in docs.values() for t in c)
    p = Counter(t for _, y, c in examples if y for t in c)
    names = list(n)
    weights = dict(zip(names, toxicity.term_weights(np.array([n[t] for t in names], float), np.array([p[t] for t in names], float), len(examples), sum(y for _, y, _ in examples))))

    def unit(counts):
        v = {t: (1 + math.log(k)) * weights[t] for t, k in counts.items() if t in weights}
        length = math.sqrt(sum(w * w for w in v.values()))
        return {t: w / length for t, w in v.items()}

    vectors = {i: unit(c) for i, c in docs.items()}
    for c in [*list(docs.values())[:40], {b"w1": 3, b"unknown": 5}]:
        q = unit(c)
        got = index.nearest(index.vector(c))
        cosine = {i: sum(w * q.get(t, 0) for t, w in v.items()) for i, v in vectors.items()}
        assert np.allclose([c for c, _ in got], sorted((c for c in cosine.values() if c > 0), reverse=True)[:15])
        assert all(math.isclose(cosine[index.ids[k]], c, abs_tol=1e-6) for c, k in got)
    alone = index.nearest(index.vector(docs[0]), leave=index.ids.index(0))
    assert 0 not in [index.ids[k] for _, k in alone] and index.ids[alone[0][1]] == 2000


def test_every_term_of_the_examples_is_kept(spark):
    rows, labels = corpus(100)
    index = toxicity.fit(table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert set(index.vocabulary) == {w for _, t, _ in rows for w in toxicity.words(t)} and len(index.ids) == 100


def test_rows_that_repeat_an_id_give_one_example(spark):
    rows, labels = corpus(60)
    docs = table(spark, rows + [(3, f"more {k}", "a") for k in range(50)])
    index = toxicity.fit(docs, spark.createDataFrame(labels + labels, "doc_id long, quality int, toxic int"))
    assert sorted(index.ids) == list(range(60))


def test_without_labels_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = table(spark, ODD)
    index = toxicity.fit(docs, none)
    assert {r["score"] for r in toxicity.score(docs, index).collect()} == {0.0}
    assert toxicity.score(table(spark, []), index).count() == 0


def test_equal_texts_get_equal_scores(spark):
    rows, labels = corpus(140)
    index = toxicity.fit(table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    out = toxicity.score(table(spark, [(i, rows[0][1], "a") for i in range(20)]), index)
    assert out.select("score").distinct().count() == 1
    assert out.agg(F.countDistinct("predicted")).first()[0] == 1


def test_a_bound_on_the_light_terms_is_never_passed():
    r = np.random.default_rng(5)
    for _ in range(3000):
        q, e = np.abs(r.normal(0, 1, (2, 6)))
        q[3:] *= r.choice([1e-4, 0.01, 0.05])
        e = q + r.choice([0, 0.001, 0.1, 1.0]) * e
        q, e = q / np.linalg.norm(q), e / np.linalg.norm(e)
        rest = float(np.linalg.norm(q[3:]))
        assert q[:3] @ e[:3] >= toxicity._least(min(float(q @ e), 1.0), rest)


def test_few_whole_vectors_are_read():
    """Examples that differ from the text in its heavy terms are left out by these, though the light terms weigh 0.04."""
    light = {f"c{k}".encode(): 1 for k in range(4)}
    examples = [{b"a": 10_000, b"b": 10_000 - i} | light for i in range(40)] + [{b"a": 10_000, b"b": 168 + i % 100} | light for i in range(360)]
    examples += [{f"f{i}".encode(): 3} | light for i in range(3000)]
    index = toxicity.Index((i, 0, list(c), list(c.values())) for i, c in enumerate(examples))
    read, ranked = [], index._ranked

    def count(*args):
        out = ranked(*args)
        read.append(len(out[0]))
        return out

    index._ranked = count
    near = index.nearest(index.vector(examples[0]))
    assert sum(read) <= 40 and len(near) == 15 and {index.ids[k] for _, k in near} <= set(range(40))
