import numpy as np

from velatura.llm import langid
from velatura.llm.common import fold

from .helpers import ODD, SCHEMA, prose

EN = ("the", "house", "with", "walking", "through", "weather", "thought", "shining")
DE = ("das", "häuschen", "schnell", "durch", "geschichte", "zwischen", "über", "schön")


def corpus(spark, n=300):
    rows = [(i, prose(i, 40, (EN, DE)[i % 2]), ("en", "de")[i % 2], "s", 1) for i in range(n)]
    rows += [(i, t, None, s, 1) for i, t, s in ODD] + [(5000, None, "en", "s", 1), (5001, "123 !!", "xx", None, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def test_held_out_accuracy(spark):
    docs = corpus(spark)
    held = fold("doc_id", 4) == 2
    model = langid.fit(docs, ~held)
    assert set(model.languages) == {"en", "de"}
    out = langid.identify(docs, model).collect()
    for r in out:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] is not None and r["doc_id"] < 300:
            assert r["lang_nearest"] == ("en", "de")[r["doc_id"] % 2]
    by = {r["doc_id"]: r["lang_nearest"] for r in out}
    assert [by[i] for i in (900, 901, 902, 903, 5000, 5001)] == ["und"] * 6
    assert by[904] in ("en", "de")


def test_rejects_what_is_far(spark):
    model = langid.fit(corpus(spark))
    far = spark.createDataFrame([(1, "żółć gęślą jaźń " * 9, "x", "s", 1), (2, prose(7, 60, EN), "x", "s", 1)], SCHEMA)
    assert {r["doc_id"]: r["rejected"] for r in langid.identify(far, model).collect()} == {1: True, 2: False}


def test_counts_are_those_of_each_text_alone():
    texts = ["Abc déf", None, "", "x", "a" * 5000, "ÉÈ 12 z"] * 3
    whole = langid.counts(texts)
    for t, row in zip(texts, whole):
        assert np.array_equal(langid.counts([t])[0], row)
    assert whole[4].sum() == 2 * 5000 + 1  # 5001 pairs and 5000 triples of " aaa...a "


def test_clusters():
    r = np.random.default_rng(1)
    x = np.abs(np.concatenate([r.normal(c, 0.02, (30, 3)) for c in np.eye(3)]))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c, floor = langid.cluster(x, 3)
    assert sorted(np.argmax(c, axis=1).tolist()) == [0, 1, 2] and (floor > 0.9).all()


def test_no_training_rows_and_empty(spark):
    docs = spark.createDataFrame([(1, "word", None, "s", 1)], SCHEMA)
    model = langid.fit(docs)
    assert [r["lang_nearest"] for r in langid.identify(docs, model).collect()] == ["und"]
    assert langid.identify(docs.where("false"), model).count() == 0
