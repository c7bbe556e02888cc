import math

import pytest
from pyspark.sql import functions as F

from velatura.llm import quality
from velatura.llm.common import fold

from .helpers import ODD, prose, table


def corpus(n=300):
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        t = prose(i, 50)
        rows.append((i, " | ".join(t.upper().split()) + " !!" if bad else t, "bad.org/x" if i % 10 == 0 else f"s{i % 4}/p{i % 3}"))
        labels.append((i, int(not bad), 0))
    return rows, labels


def parts(spark):
    rows, labels = corpus()
    return table(spark, rows + ODD), spark.createDataFrame([*labels, (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int"), rows


def site():
    return F.substring_index("source", "/", 1), F.col("source")


def test_held_out_documents(spark):
    docs, labels, rows = parts(spark)
    held = fold("doc_id", 5) == 0
    model = quality.fit(docs, labels, ~held)
    out = quality.posteriors(docs, model, *site()).withColumn("held", held).collect()
    assert len(out) == len(rows) + len(ODD)
    for r in out:
        if r["doc_id"] is not None and r["doc_id"] < 300:
            assert r["kept"] == (r["doc_id"] % 5 != 0)


def test_posteriors_are_the_formula(spark):
    docs, labels, _ = parts(spark)
    model = quality.fit(docs, labels)
    out = quality.posteriors(docs, model, *site()).collect()
    for r in out:
        p = min(max(r["path_posterior"], 1e-6), 1 - 1e-6)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-(r["evidence"] + math.log(p / (1 - p))))))
    by = {r["host"]: r["host_posterior"] for r in out}
    assert by["bad.org"] < min(v for k, v in by.items() if k and k.startswith("s"))


def test_posteriors_against_plain_sums(spark):
    docs, labels, _ = parts(spark)
    model = quality.fit(docs, labels)
    out = quality.posteriors(docs, model, *site()).collect()
    base = math.log(model.share / (1 - model.share))
    p = [1 / (1 + math.exp(-(r["evidence"] + base))) for r in out]

    def strength(groups, above):
        many = {k: v for k, v in groups.items() if len(v) > 1}
        n = sum(map(len, many.values()))
        noise = max(sum((x - sum(v) / len(v)) ** 2 for v in many.values() for x in v) / (n - len(many)), 1e-9)
        between = max((sum(len(v) * (sum(v) / len(v) - above[k]) ** 2 for k, v in many.items()) - len(many) * noise) / n, 0)
        return min(max(noise / between, 1.0), 1e6) if between else 1e6

    hosts, paths = {}, {}
    for r, x in zip(out, p):
        hosts.setdefault(r["host"], []).append(x)
        paths.setdefault((r["host"], r["path"]), []).append(x)
    share = sum(p) / len(p)
    a = strength(hosts, dict.fromkeys(hosts, share))
    of_host = {k: (sum(v) + a * share) / (len(v) + a) for k, v in hosts.items()}
    b = strength(paths, {k: of_host[k[0]] for k in paths})
    for r in out:
        v = paths[(r["host"], r["path"])]
        assert r["host_posterior"] == pytest.approx(of_host[r["host"]], rel=1e-6)
        assert r["path_posterior"] == pytest.approx((sum(v) + b * of_host[r["host"]]) / (len(v) + b), rel=1e-6)


def test_clashing_names_and_text_ids(spark):
    docs, labels, rows = parts(spark)
    odd = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "source", F.lit(1).alias("_h"), F.lit(2).alias("_p"), F.lit(3).alias("host_posterior"), F.lit(4).alias("path_posterior"), F.lit(5).alias("_q_score"))
    out = quality.quality_filter(odd, labels.withColumn("doc_id", F.col("doc_id").cast("string")), *site())
    assert out.columns == odd.columns
    assert sorted(int(r["doc_id"]) for r in out.collect() if r["doc_id"] is not None and int(r["doc_id"]) < 300) == [i for i in range(300) if i % 5]


def test_sparse_sites_shrink_to_the_mean(spark):
    rows = [("h1", "h1/a", 5.0)] * 200 + [("h2", "h2/a", -5.0)] * 200 + [("new", "new/a", 5.0)]
    judged = spark.createDataFrame(rows, "_q_host string, _q_path string, _q_evidence double")
    by = {r["_q_h"]: r["_q_above"] for r in quality.site_posteriors(judged, 0.0).collect()}
    assert by["h2"] < 0.1 < 0.9 < by["h1"]
    assert 0.5 < by["new"] < by["h1"]


def test_filter(spark):
    docs, labels, _ = parts(spark)
    out = quality.quality_filter(docs, labels, *site())
    assert out.columns == docs.columns
    ids = [r["doc_id"] for r in out.select("doc_id").collect() if r["doc_id"] is not None and r["doc_id"] < 300]
    assert sorted(ids) == [i for i in range(300) if i % 5]


def test_without_labels_all_stay(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = table(spark, ODD)
    assert quality.quality_filter(docs, none, *site()).count() == len(ODD)
    assert quality.quality_filter(table(spark, []), none, *site()).count() == 0
