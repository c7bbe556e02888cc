"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are the words of the lower-cased text (anything but ASCII letters, digits and non-ASCII bytes
parts words), all of those that any example holds. A vector is (1 + log tf) * idf over them, of length 1. As toxic words are a few among
hundreds of others, the plain idf finds texts on the same topic, not of the same kind (0.35 of the held-out toxic texts of sf 0.1 are then told); it is
therefore scaled by what a term tells about the label, e^4 / (e^4 + 1), where e is what the term's toxic share surely (by two
standard errors, with four examples' worth of prior) exceeds that of all examples by, in log odds. No term is left out: one that tells nothing keeps a millionth of its idf.

The index holds, for each term, the examples that have it, in blocks of ``BLOCK`` examples with the largest weight of each
block. For a document the largest weights bound every block's cosines; blocks are scored in the
order of their bounds until the bound falls below the k-th best cosine, so the k nearest examples are exact.
They vote with weight 1 / (1.05 - cosine); a logistic curve fitted on the votes that the examples get from
each other turns the share of toxic votes into a probability. Documents near no example (no known term)
get the share of toxic ones among such examples.

The examples are a sample of about ``EXAMPLES`` labelled rows at most, by a hash of doc_id, so the index
is bounded by that and is broadcast; every document is scored from its whole text, in one pass, without a shuffle.

Defined cases: null and empty texts have no terms and get the score of such examples; labels that are null or of unknown
documents are ignored, of repeated labels of a document the largest counts, of rows that repeat an example's id the least text; without any label all scores are 0;
examples of equal cosine are taken in the order of the index; repeated rows get equal scores; very long texts are scored whole; extra columns are not read.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, in_batches, labelled_sample

EXAMPLES = 12_000
BLOCK = 64
NEAREST = 15
SURE = 2.0  # standard errors
FAINT = 1e-6
PRIOR = 4.0
SEED = 4  # blocks scored first
LIGHT = 0.05  # length of what is left of a text's vector when its heavy terms are taken
_PARTS = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_PARTS).split() if text else []


def term_weights(n: np.ndarray, p: np.ndarray, examples: int, toxic: int) -> np.ndarray:
    """Scaled idf of terms that ``n`` of the examples hold, ``p`` of them toxic."""
    idf = np.log((1 + examples) / (1 + n)) + 1
    if not 0 < toxic < examples:
        return idf
    share = toxic / examples
    yes, no = p + PRIOR * share, n - p + PRIOR * (1 - share)
    # what the term's toxic share surely exceeds that of all examples by, in log odds
    least = np.maximum(np.log(yes / no) - math.log(share / (1 - share)) - SURE * np.sqrt(1 / yes + 1 / no), 0)
    return idf * (least**4 / (least**4 + 1) + FAINT)


def _ranges(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges in a row, and the range of each."""
    size = stop - start
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(len(of)) + (start - np.cumsum(size) + size)[of], of


def _least(floor: float, rest: float) -> float:
    """The cosine over a text's heavy terms below which an example cannot reach ``floor`` over all, if the light ones have the length ``rest``.

    The more of an example's length lies in the heavy terms, the less is left for the light ones: the two angles add up.
    """
    length = math.sqrt(1 - rest * rest)
    return length * (length * floor - rest * math.sqrt(max(1 - floor * floor, 0.0) + 1e-6)) - 1e-6


class Index:
    """Labelled examples as a block-max inverted index.

    ``examples`` are (id, label, terms, numbers). Arrays: a term's cells are ``cells[t]`` to ``cells[t + 1]``, a cell is a block (``block``) in
    which the term occurs, with its largest weight there (``most``) and its postings ``first[c]`` to ``first[c + 1]``: example (``place``) and ``weight``.
    The vectors themselves stand in ``begin``, ``term`` and ``own``, for the exact cosines.
    """

    def __init__(self, examples: Iterable[tuple[object, int, list[bytes], Sequence[int]]]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        ids, labels, at, number = [], [], [], []
        for i, y, terms, n in examples:
            ids.append(i)
            labels.append(y)
            at.append(np.fromiter((self.vocabulary.setdefault(t, len(self.vocabulary)) for t in terms), np.int32, len(terms)))
            number.append(np.asarray(n, np.int32))
        labels, size, length = np.array(labels, np.float64), len(self.vocabulary), np.array([len(a) for a in at], np.int64)
        term = np.concatenate(at) if at else np.empty(0, np.int32)
        n, p = np.bincount(term, minlength=size), np.bincount(term, np.repeat(labels, length), minlength=size)
        self.idf = term_weights(n.astype(np.float64), p, len(labels), int(labels.sum()))
        share = float(labels.mean()) if len(labels) else 0.0
        self.base = (labels[length == 0].sum() + share) / ((length == 0).sum() + 1)
        # like next to like: by the heaviest term, so that blocks have few large weights
        head = [int(a[self.unit(a, k).argmax()]) if len(a) else size for a, k in zip(at, number)]
        order = sorted(range(len(at)), key=lambda i: (head[i], i))
        self.ids, self.labels = [ids[i] for i in order], labels[order]
        sort = [np.argsort(at[i]) for i in order]  # terms in one order, so that equal vectors have equal cosines
        self.begin = np.append(0, np.cumsum(length[order]))
        self.term = np.concatenate([at[i][k] for i, k in zip(order, sort)]) if order else term
        self.number = np.concatenate([number[i][k] for i, k in zip(order, sort)]) if order else np.empty(0, np.int32)
        self.slope, self.shift = 1.0, 0.0
        self._dense = None  # the inverted index is made where it is first searched, not on the driver

    def _invert(self) -> None:
        """The weights and the inverted index, from the vectors' terms and numbers."""
        raw = (1 + np.log(self.number)) * self.idf[self.term]
        of = np.repeat(np.arange(len(self.ids), dtype=np.int32), np.diff(self.begin))
        self.own = (raw / np.sqrt(np.bincount(of, raw * raw, minlength=len(self.ids)))[of]).astype(np.float32)
        by = np.argsort(self.term, kind="stable")
        self.place, self.weight, term = of[by], self.own[by], self.term[by]
        begins = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (self.place[1:] // BLOCK != self.place[:-1] // BLOCK)]) if len(term) else np.empty(0, np.int64)
        self.first = np.append(begins, len(term)).astype(np.int32)
        self.block = self.place[begins] // BLOCK
        self.most = np.maximum.reduceat(self.weight, begins) if len(begins) else np.empty(0, np.float32)
        self.cells = np.searchsorted(term[begins], np.arange(len(self.vocabulary) + 1))
        self.blocks = -(-len(self.ids) // BLOCK)
        self._dense = np.zeros(len(self.vocabulary))

    def __getstate__(self) -> bytes:
        """What the rest follows from, packed: a sixth of the whole."""
        kept = {k: getattr(self, k) for k in ("ids", "labels", "begin", "term", "number", "idf", "base", "slope", "shift")}
        return zlib.compress(pickle.dumps(kept | {"vocabulary": b" ".join(self.vocabulary)}), 1)

    def __setstate__(self, state: bytes) -> None:
        self.__dict__.update(pickle.loads(zlib.decompress(state)))
        self.vocabulary = {t: i for i, t in enumerate(self.vocabulary.split())}
        self._dense = None

    def unit(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = (1 + np.log(n)) * self.idf[at]
        return w / math.sqrt(float(w @ w)) if len(w) else w

    def vector(self, counts: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights) of a text, the heaviest first."""
        at = np.array(list(map(self.vocabulary.get, counts, repeat(-1))), np.int64)
        n = np.array(list(counts.values()), np.float64)
        known = np.flatnonzero(at >= 0)
        at = at[known]
        q = self.unit(at, n[known])
        order = np.lexsort((at, -q))
        return at[order], q[order]

    def nearest(self, vector: tuple[np.ndarray, np.ndarray], k: int = NEAREST, leave: int = -1) -> list[tuple[float, int]]:
        """The k examples of largest cosine above 0, (cosine, place), ties by place; example ``leave`` is left out.

        Blocks and examples are first ranked by the text's heavy terms; the length of its light ones (``rest``) bounds what these
        can add. Examples that could be among the k best are computed from their whole vectors.
        """
        at, q = vector
        if not len(at):
            return []
        if self._dense is None:
            self._invert()
        left = np.cumsum((q * q)[::-1])[::-1]  # squared length of the terms from each place on
        heavy = int(np.count_nonzero(left > LIGHT * LIGHT))
        rest = math.sqrt(left[heavy]) if heavy < len(at) else 0.0
        place, floor = self._ranked(at[:heavy], q[:heavy], rest, k, leave)
        if heavy < len(at) and floor <= rest:  # an example without a heavy term might be among the nearest
            place, _ = self._ranked(at, q, 0.0, k, leave)
        if not len(place):
            return []
        spans = list(zip(self.begin[place].tolist(), self.begin[place + 1].tolist()))
        self._dense[at] = q
        product = self._dense[np.concatenate([self.term[a:z] for a, z in spans])]
        product *= np.concatenate([self.own[a:z] for a, z in spans])
        self._dense[at] = 0
        exact = np.add.reduceat(product, np.cumsum([0] + [z - a for a, z in spans[:-1]]))  # none is empty: it has a term of the text
        best = np.lexsort((place, -np.round(exact, 12)))[:k]
        return list(zip(exact[best].tolist(), place[best].tolist()))

    def _ranked(self, at: np.ndarray, q: np.ndarray, rest: float, k: int, leave: int) -> tuple[np.ndarray, float]:
        """Places by the terms ``at`` of all examples that ``rest`` more could bring among the k best, and the k-th best score."""
        cell, of = _ranges(self.cells[at], self.cells[at + 1])
        block, weight = self.block[cell], q[of]
        bound = np.bincount(block, weight * self.most[cell], minlength=self.blocks)
        order = np.argsort(-bound, kind="stable")
        blocks = order[:SEED]
        score = self._in_blocks(cell, block, weight, blocks, leave)
        floor = self._kth(score, k)
        live = order[bound[order] >= max(_least(floor, rest), 1e-300)]
        if len(live) > SEED:
            if 4 * len(live) < self.blocks:
                blocks = live
                score = self._in_blocks(cell, block, weight, blocks, leave)
            else:
                blocks = np.arange(self.blocks)
                score = np.zeros(self.blocks * BLOCK)
                for a, z, w in zip(self.first[self.cells[at]].tolist(), self.first[self.cells[at + 1]].tolist(), q.tolist()):
                    score[self.place[a:z]] += w * self.weight[a:z]  # a term has an example once, so slices can be added
                if leave >= 0:
                    score[leave] = 0.0
            floor = self._kth(score, k)
        found = np.flatnonzero(score > max(_least(floor, rest), 0.0))
        return blocks[found // BLOCK] * BLOCK + found % BLOCK, floor

    def _in_blocks(self, cell: np.ndarray, block: np.ndarray, weight: np.ndarray, blocks: np.ndarray, leave: int) -> np.ndarray:
        """Scores of the examples of some blocks, ``BLOCK`` for each in their order, by the cells of a text's terms, which lie in ``block`` and have its ``weight``."""
        begin = np.full(self.blocks, -1)
        begin[blocks] = np.arange(0, len(blocks) * BLOCK, BLOCK)
        own = np.flatnonzero(begin[block] >= 0)
        post, of = _ranges(self.first[cell[own]], self.first[cell[own] + 1])
        own = own[of]
        score = np.bincount(begin[block[own]] + self.place[post] % BLOCK, weight[own] * self.weight[post], minlength=len(blocks) * BLOCK)
        if leave >= 0 and begin[leave // BLOCK] >= 0:
            score[begin[leave // BLOCK] + leave % BLOCK] = 0.0
        return score

    @staticmethod
    def _kth(score: np.ndarray, k: int) -> float:
        score = score[score > 0]
        return float(np.partition(score, len(score) - k)[len(score) - k]) if len(score) >= k else 0.0

    def share(self, near: list[tuple[float, int]]) -> float:
        weights = [1 / (1.05 - min(c, 1.0)) for c, _ in near]
        return sum(w * self.labels[i] for w, (_, i) in zip(weights, near)) / sum(weights)

    def calibrate(self, shares: np.ndarray, labels: np.ndarray) -> None:
        """Fit the logistic curve on what each example gets from the others."""
        if len(set(labels.tolist())) < 2:
            return
        x, y = _logit(shares), labels
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton steps, with a pull towards the identity
            p = 1 / (1 + np.exp(-(a * x + b)))
            w = p * (1 - p)
            g = np.array([((p - y) * x).sum() + (a - 1.0), (p - y).sum() + b])
            h = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1]])
            step = np.linalg.solve(h, g)
            a, b = a - step[0], b - step[1]
            if abs(step).max() < 1e-9:
                break
        self.slope, self.shift = float(max(a, 0.05)), float(b)

    def score(self, text: str | None) -> tuple[float, list[tuple[object, float]]]:
        """Probability and evidence [(doc_id of an example, cosine)]."""
        near = self.nearest(self.vector(Counter(words(text))))
        if not near:
            return self.base, []
        p = 1 / (1 + math.exp(-(self.slope * float(_logit(np.array(self.share(near)))) + self.shift)))
        return p, [(self.ids[i], c) for c, i in near[:3]]


def _logit(share: np.ndarray) -> np.ndarray:
    p = np.clip(share, 0.01, 0.99)
    return np.log(p / (1 - p))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", keep: Column | None = None, id_col: str = "doc_id", text_col: str = "text", bound: int = EXAMPLES) -> Index:
    """The index over a bounded sample of the labelled rows for which ``keep`` (of doc_id) holds."""
    some = labelled_sample(labels, label, bound, keep)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # ``bound`` rows of two numbers: small by construction; one text to an id
    sample = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.max(label).cast("int").alias("y"), F.min("text").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            held = [Counter(words(t)) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"], "t": [b" ".join(c) for c in held], "n": [list(c.values()) for c in held]})

    held = checkpointed(in_batches(sample).mapInPandas(terms, f"doc_id {kind}, y int, t binary, n array<int>"))
    rows = held.orderBy("doc_id").toArrow()  # ``bound`` rows
    index = Index((i.as_py(), y.as_py(), t.as_py().split(), n.values.to_numpy()) for b in rows.to_batches() for i, y, t, n in zip(*b.columns))
    del rows
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        place = {i: k for k, i in enumerate(index.ids)}
        for b in batches:
            near = [index.nearest(index.vector(dict(zip(t.split(), n))), leave=place[i]) for i, t, n in zip(b["doc_id"].tolist(), b["t"], b["n"])]
            yield pd.DataFrame({"y": b["y"], "share": pd.array([index.share(x) if x else None for x in near], dtype="Float64")})

    found = in_batches(held.repartition(32)).mapInPandas(votes, "y int, share double").where("share is not null").toArrow()  # two numbers for each example
    shares, y = found["share"].to_numpy(), found["y"].to_numpy().astype(np.float64)
    order = np.lexsort((y, shares))  # sums in one order
    index.calibrate(shares[order], y[order])
    shared.destroy()
    return index


def score(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted, evidence): evidence holds the nearest examples as (doc_id, cosine)."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [shared.value.score(t) for t in b["text"]]
            p = [x[0] for x in out]
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": p, "predicted": [int(x >= 0.5) for x in p], "evidence": [[{"doc_id": i, "cosine": c} for i, c in x[1]] for x in out]})

    kind = docs.schema[id_col].dataType.simpleString()
    return in_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).mapInPandas(run, f"doc_id {kind}, score double, predicted int, evidence array<struct<doc_id:{kind},cosine:double>>")
