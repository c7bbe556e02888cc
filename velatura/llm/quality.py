"""Document quality by hierarchical empirical Bayes.

Evidence. A logistic model over text statistics (fitted on a bounded sample of labelled rows) gives each
document a log likelihood ratio: its log odds less those of the training rows at large.

Priors. The shares of good documents form a hierarchy: all documents, their hosts, the paths of a host.
Host h with n documents whose probabilities sum to s has the posterior mean

    theta_h = (s + a * theta) / (n + a)

and a path of it theta_p = (s_p + b * theta_h) / (n_p + b). The strengths a and b come from the data by
moments: from how much more the sites' means vary than the means of so many documents would by
chance. Sparse sites so stay near what is above them. The score is the posterior
sigmoid(evidence + logit(theta_p)), and documents of ``keep_at`` or more are kept.

Scale. One pass over the texts without a shuffle; then only (id, host, path, probability) move: sums with map-side
combine by host and path, and a join back of one row per path, so a hot host is no hot task.

Defined cases: null and empty texts are scored by their statistics (all 0); a null site is a site of its own; labels that are null
are ignored, of repeated labels of a document the largest counts; without labels of both kinds the evidence is 0 and the
global share is 1, so all documents are kept; rows that repeat an id are scored each, and each is a training row; very long texts are read whole; a score of
just ``keep_at`` is kept; an empty table gives an empty result; extra columns are kept by ``quality_filter`` whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, give_back, in_batches, labelled_sample, lean, small_side

EXAMPLES = 12_000
_UPPER = bytes(range(65, 91))
_ALNUM = bytes(c for c in range(256) if chr(c).isalnum() and c < 128 or c >= 128)
_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"!#$%&*+/<=>@\\^_`{|}~[]"
FEATURES = 12


def features(text: str | None) -> list[float]:
    """Statistics of the whole text; shares are of characters or words, lengths are logarithms."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    if not n:
        return [0.0] * FEATURES
    count = Counter(words)
    spaces = size - len(raw.translate(None, _SPACE))
    symbols = size - len(raw.translate(None, _SYMBOLS))
    other = len(raw.translate(None, _ALNUM)) - spaces
    upper = size - len(raw.translate(None, _UPPER))
    repeated = sum(map(eq, words, words[1:]))
    top = count.most_common(1)[0][1]
    lines = raw.count(b"\n") + 1
    return [
        math.log1p(n), math.log(size / n), len(count) / n, math.log(len(count) / n) * math.log1p(n), repeated / n, top / n if n > 20 else 0.0,
        symbols / size, math.log1p(100 * symbols / size), other / size, upper / size, math.log1p(20 * upper / size), math.log(n / lines),
    ]


@dataclass
class Classifier:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray  # the last one is the constant
    share: float  # of good documents among the training rows

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log likelihood ratios of good against bad."""
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return z @ self.weights[:-1] + self.weights[-1] - _logit(self.share)


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def fit(docs: DataFrame, labels: DataFrame, keep: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", bound: int = EXAMPLES) -> Classifier:
    """A classifier from about ``bound`` labelled rows at most for which ``keep`` (of doc_id) holds."""
    some = labelled_sample(labels, label, bound, keep)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(some), "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b[label], "x": [features(t) for t in b["text"]]})

    rows = in_batches(texts).mapInPandas(lean(run), f"doc_id {docs.schema[id_col].dataType.simpleString()}, y int, x array<double>").orderBy("doc_id").collect()  # ``bound`` rows of numbers
    y = np.array([r["y"] for r in rows], np.float64)
    if len(set(y.tolist())) < 2:
        return Classifier(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES + 1), 0.5)
    x = np.array([r["x"] for r in rows])
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    z = np.c_[np.clip((x - mean) / spread, -8, 8), np.ones(len(x))]
    w, pull = np.zeros(FEATURES + 1), np.r_[np.ones(FEATURES), 1e-3]
    for _ in range(100):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(pull), z.T @ (p - y) + pull * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Classifier(mean, spread, w, float(y.mean()))


def _strength(groups: DataFrame, above: Column) -> float:
    """The number of documents that the level above counts for, by moments over groups (n, s, q: sum of p and of p squared)."""
    mean = F.col("s") / F.col("n")
    r = groups.where("n > 1").agg(
        F.sum(F.col("n") * (mean - above) * (mean - above)).alias("between"), F.sum(F.col("q") - F.col("s") * mean).alias("within"),
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
    ).first()
    if not r["n"] or r["n"] <= r["k"]:
        return 10.0
    noise = max(r["within"] / (r["n"] - r["k"]), 1e-9)  # variance of one document about its group
    between = max((r["between"] - r["k"] * noise) / r["n"], 0.0)  # of the groups' true means
    return float(min(max(noise / between, 1.0), 1e6)) if between > 0 else 1e6


def _judged(docs: DataFrame, classifier: Classifier, host: Column, path: Column, text_col: str) -> DataFrame:
    """``docs`` with ``_q_host``, ``_q_path`` and ``_q_evidence``."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    @F.pandas_udf("double")
    def evidence(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series(shared.value.evidence(np.array([features(x) for x in t]).reshape(-1, FEATURES)))
        give_back()

    # the texts go to Python, but need not come back
    sited = in_batches(docs).withColumns({"_q_host": host.cast("string"), "_q_path": path.cast("string")})
    return sited.withColumn("_q_evidence", evidence(F.col(text_col)))


def site_posteriors(judged: DataFrame, base: float) -> DataFrame:
    """(_q_h, _q_p, _q_above, _q_prior): posteriors of host and path, one row per path, from (_q_host, _q_path, _q_evidence)."""
    p = 1 / (1 + F.exp(-(F.col("_q_evidence") + base)))
    paths = judged.groupBy(F.col("_q_host").alias("host"), F.col("_q_path").alias("path")).agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("s"), F.sum(p * p).alias("q"))
    paths = checkpointed(paths)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    total = hosts.agg(F.sum("n"), F.sum("s")).first()
    share = total[1] / total[0] if total[0] else 1.0
    a = _strength(hosts, F.lit(share))
    above = hosts.select(F.col("host").alias("_q_h"), ((F.col("s") + a * share) / (F.col("n") + a)).alias("_q_above"))
    paths = paths.join(above, F.col("host").eqNullSafe(F.col("_q_h")))
    b = _strength(paths, F.col("_q_above"))
    return checkpointed(paths.select("_q_h", F.col("path").alias("_q_p"), "_q_above", ((F.col("s") + b * F.col("_q_above")) / (F.col("n") + b)).alias("_q_prior")))


def _with_score(judged: DataFrame, sites: DataFrame) -> DataFrame:
    joined = judged.join(small_side(sites), F.col("_q_host").eqNullSafe(F.col("_q_h")) & F.col("_q_path").eqNullSafe(F.col("_q_p")), "left")
    prior = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), F.col("_q_prior")))
    return joined.withColumn("_q_score", 1 / (1 + F.exp(-(F.col("_q_evidence") + F.log(prior / (1 - prior))))))


def posteriors(docs: DataFrame, classifier: Classifier, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", keep_at: float = 0.5) -> DataFrame:
    """(doc_id, host, path, evidence, host_posterior, path_posterior, score, kept), one row per row of ``docs``."""
    few = [id_col, "_q_host", "_q_path", "_q_evidence"]
    judged = checkpointed(_judged(docs.select(F.col(id_col), F.col(text_col), host.alias("_q_a"), path.alias("_q_b")), classifier, F.col("_q_a"), F.col("_q_b"), text_col).select(*few))
    out = _with_score(judged, site_posteriors(judged, _logit(classifier.share)))
    return out.select(
        F.col(id_col).alias("doc_id"), F.col("_q_host").alias("host"), F.col("_q_path").alias("path"), F.col("_q_evidence").alias("evidence"),
        F.col("_q_above").alias("host_posterior"), F.col("_q_prior").alias("path_posterior"), F.col("_q_score").alias("score"), (F.col("_q_score") >= keep_at).alias("kept"),
    )


def quality_filter(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", keep_at: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the posterior keeps, with their columns.

    The texts are read once for the sites' posteriors and once more to be passed on, so that they are not written in between.
    """
    classifier = fit(docs, labels, None, id_col, text_col)
    names = [f"_qf_{k}" for k in range(len(docs.columns))]  # whatever the columns are called
    sited = docs.withColumns({"_q_site_host": host.cast("string"), "_q_site_path": path.cast("string")}).toDF(*names, "_qf_host", "_qf_path")
    judged = _judged(sited, classifier, F.col("_qf_host"), F.col("_qf_path"), names[docs.columns.index(text_col)])
    sites = site_posteriors(judged.select("_q_host", "_q_path", "_q_evidence"), _logit(classifier.share))
    return _with_score(judged, sites).where(F.col("_q_score") >= keep_at).select(*names).toDF(*docs.columns)
