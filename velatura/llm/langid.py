"""Language identification by the nearest of several centroids per language.

A text's vector counts its byte 2-grams and 3-grams (lower-cased UTF-8, ASCII non-letters as one
space, a space at either end), hashed into ``DIM`` places; weights are sqrt(count) * idf and
the length is 1. Each language's training vectors are clustered (spherical k-means, ``CENTROIDS`` at
most), and a text gets the language of the centroid of largest cosine. A text that is farther from
its centroid than nearly all training texts of that cluster were is rejected.

The training rows are a sample of about ``PER_LANGUAGE`` rows a language at most, by a hash of doc_id; clusters are
computed one language a task. Centroids are ``DIM`` numbers each and are broadcast. Every whole text is scored in
one pass without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; with no training rows all are ``und``; ties go to
the first language in code-point order; repeated rows get equal results; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, in_batches, unit_hash

DIM = 4096
CENTROIDS = 4
PER_LANGUAGE = 600
_LETTERS = bytes(c if chr(c).isalpha() and c < 128 or c >= 128 else 32 for c in range(256))
_LETTER = regex.compile(r"\p{L}")
_CHUNK = 1 << 20  # bytes of text that are counted at a time


def counts(texts: list[str | None]) -> np.ndarray:
    """n-gram counts, one row of ``DIM`` a text."""
    out = np.zeros((len(texts), DIM), np.float32)
    held: list[bytes] = []
    first = size = 0
    for i, t in enumerate(texts):
        clean = b" " + b" ".join(t.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()) + b" " if t else b" "
        held.append(clean)
        size += len(clean)
        if size >= _CHUNK or i == len(texts) - 1:
            _count(held, out[first : i + 1])
            held, first, size = [], i + 1, 0
    return out


def _count(texts: list[bytes], out: np.ndarray) -> None:
    """Texts end in a space and begin with one; grams that reach into the next text begin in its row and are left out."""
    joined = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
    lengths = np.array([len(t) for t in texts])
    row = np.repeat(np.arange(len(texts), dtype=np.int64) * DIM, lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(joined))  # bytes to the end of the text
    two = joined[:-1] * np.uint32(257) + joined[1:]
    for gram, n in ((two * np.uint32(2654435761), 2), ((two[:-1] * np.uint32(257) + joined[2:]) * np.uint32(2246822519), 3)):
        place = row[: len(gram)] + ((gram >> np.uint32(15)) % np.uint32(DIM)).astype(np.int64)
        inside = left[: len(gram)] >= n
        out += np.bincount(place[inside], minlength=out.size).reshape(out.shape).astype(np.float32)


def unit(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.sqrt(rows) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm == 0, 1, norm)


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of unit rows by spherical k-means from far-apart beginnings, and each cluster's least cosine that is still near."""
    centre = x.mean(axis=0)
    seeds = [int(np.argmax(x @ centre))]
    while len(seeds) < min(k, len(x)):
        seeds.append(int(np.argmin((x @ x[seeds].T).max(axis=1))))
    c = x[seeds]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    cosine = x @ c.T
    own, best = cosine.argmax(axis=1), cosine.max(axis=1)
    floor = np.array([np.quantile(best[own == j], 0.005) - 0.05 if (own == j).any() else 1.0 for j in range(len(c))])
    return c, floor


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    floors: np.ndarray
    languages: list[str]  # of each centroid


def fit(docs: DataFrame, keep: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, k: int = CENTROIDS) -> Model:
    """A model from a bounded sample of the rows for which ``keep`` (of doc_id) holds and lang and text are not null."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if keep is not None:
        rows = rows.where(keep)
    # one row per language; the rate of each is what brings its rows down to the bound
    rates = {r["lang"]: min(1.0, per_language / r["count"]) for r in rows.groupBy("lang").count().collect()}
    if not rates:
        return Model(np.ones(DIM), np.zeros((0, DIM)), np.zeros(0), [])
    rate = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])[F.col("lang")]
    some = rows.where(unit_hash(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 29) < rate)

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at : at + 256]
                c = counts(part["text"].tolist())
                at_ = [np.flatnonzero(r) for r in c]
                yield pd.DataFrame({"lang": part["lang"].to_numpy(), "at": at_, "n": [r[i] for r, i in zip(c, at_)]})

    vectors = checkpointed(in_batches(some).mapInPandas(sparse, "lang string, at array<int>, n array<float>"))
    total = vectors.count()
    df = np.zeros(DIM)
    for r in vectors.select(F.explode("at").alias("at")).groupBy("at").count().collect():  # DIM rows at most
        df[r["at"]] = r["count"]
    idf = np.log((1 + total) / (1 + df)) + 1

    def grouped(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(b), DIM), np.float32)
        for i, (at, n) in enumerate(zip(b["at"], b["n"])):
            x[i, at] = n
        x = unit(x, idf)
        x = x[np.abs(x).sum(axis=1) > 0]
        if not len(x):
            return pd.DataFrame({"lang": [], "centroid": [], "floor": []})
        c, floor = cluster(x, k)
        return pd.DataFrame({"lang": key[0], "centroid": list(c.astype(np.float64)), "floor": floor})

    found = vectors.groupBy("lang").applyInPandas(grouped, "lang string, centroid array<double>, floor double").collect()  # k rows a language
    found.sort(key=lambda r: (r["lang"], r["centroid"]))
    return Model(idf, np.array([r["centroid"] for r in found]).reshape(-1, DIM), np.array([r["floor"] for r in found]), [r["lang"] for r in found])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_nearest, score, rejected): the nearest language, its cosine, and whether that is too far to be it.

    ``lang_nearest`` is ``und`` where there is nothing to tell by; with ``rejected`` it is up to the caller to take ``und``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        centroids, idf = m.centroids.T.astype(np.float32), m.idf.astype(np.float32)
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at : at + 256]
                texts = part["text"].tolist()
                known = np.array([bool(m.languages) and t is not None and _LETTER.search(t) is not None for t in texts])
                lang, score, far = np.full(len(texts), "und", object), np.zeros(len(texts)), np.ones(len(texts), bool)
                if known.any():
                    cosine = unit(counts([t for t, ok in zip(texts, known) if ok]), idf) @ centroids
                    best = cosine.argmax(axis=1)
                    top = cosine[np.arange(len(best)), best]
                    lang[known] = [m.languages[j] for j in best]
                    score[known] = np.clip(top, 0, 1)
                    far[known] = top < m.floors[best]
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "lang_nearest": lang, "score": score, "rejected": far})

    kind = docs.schema[id_col].dataType.simpleString()
    return in_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).mapInPandas(run, f"doc_id {kind}, lang_nearest string, score double, rejected boolean")
