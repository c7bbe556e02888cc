"""Documents scored by masked pseudo-likelihood under a bidirectional window network.

Tokens are the words of the lower-cased text. The network predicts the token at a place from the two tokens
before and the two after it, the place itself being masked:

    h = tanh(b + T1[w-2] + T2[w-1] + T3[w+1] + T4[w+2])
    P(w | both sides) = P(class of e | h) * P(e | its class, h) * P(w | e)

where e is the network's entry of w: the ``OWN`` most frequent words have an entry each (P(w | e) = 1), all others share ``SHARED``
entries by hash, and P(w | e) is the word's part of all tokens of its entry, from the counts of all words of the corpus. So
the probabilities of all words seen sum to one at every place. A document's score is the sum of the log probabilities of all its tokens.

What is gathered grows with the corpus: the count of every word, and one trained copy of the network for every ``SHARD`` tokens.
The counts of the ``LISTED`` most frequent words are broadcast; those of all other words stay a table, which the
documents' rare words (about a tenth of the tokens) are joined with. None of them is a hot key, being rarer than the listed ones.

Training. Texts are encoded once (two bytes a token) and dealt to shards by a hash; each shard trains a copy (Adagrad) in the order of the
hash, in ``ROUNDS`` rounds with every ``ROUNDS``-th place each, so that every token is a target once. After a round the copies are averaged,
weighted by their targets, 64 at a time. Neither shards nor order depend on how the input is split.

Defined cases: null and empty texts have no tokens, log likelihood 0 and a null mean; tokens beyond the ends are
a padding entry; very long texts are scored whole; ties in frequency go to the word first in byte order; repeated rows get equal scores;
an empty corpus scores nothing; words whose 64-bit hashes agree count as one; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, in_batches
from .toxicity import words

CLASSES = 48
WIDTH = 48  # entries of a class
SHARED = 512  # a power of two
OWN = CLASSES * WIDTH - SHARED - 1
LISTED = 1 << 16  # words whose counts are broadcast, at most
HIDDEN = 24
ROUNDS = 2
BATCH = 6144  # targets of a step, at most
SHARD = 1 << 21  # tokens meant for a shard
SHARDS = 1 << 16  # beyond so many, shards grow instead
PAD = 0
_PLACES = (-2, -1, 1, 2)
_PART = 1 << 20  # tokens trained on or scored at a time, but for a longer text
_SLICE = 8192  # places computed at a time
_CHUNK = 4096  # weights in one row of what is averaged
_FAN = 64  # copies added up at a time


def hashed(word: bytes) -> int:
    """The hash by which Spark's xxhash64 knows the word, as a signed number."""
    h = xxhash.xxh64_intdigest(word, 42)
    return h - (1 << 64) if h >> 63 else h


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(h, w, n): hash, word and number of every word of all documents, written to the checkpoint folder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count: Counter = Counter()

        def out() -> pd.DataFrame:
            return pd.DataFrame({"w": list(count), "n": list(count.values())})

        for b in batches:
            for t in b[text_col]:
                count.update(words(t))
            if len(count) > 500_000:
                yield out()
                count.clear()
        yield out()

    counted = in_batches(docs.select(text_col)).mapInPandas(run, "w binary, n long")
    return checkpointed(counted.groupBy(F.xxhash64("w").alias("h")).agg(F.min("w").alias("w"), F.sum("n").alias("n")))


@dataclass
class Vocabulary:
    """Frequent words, each with its entry and log P(word | entry), and the tokens of every entry."""

    listed: list[bytes]
    entry: np.ndarray
    part: np.ndarray
    totals: np.ndarray

    @property
    def tokens(self) -> int:
        return int(self.totals.sum())

    def encoder(self):
        """Text -> (entries, log P(word | entry) summed over listed words, hashes of the other words)."""
        place = {w: i for i, w in enumerate(self.listed)}
        entry, part = self.entry, self.part

        def encode(text: str | None) -> tuple[np.ndarray, float, np.ndarray]:
            own = words(text)
            get = place.get
            at = np.array(list(map(get, own, repeat(-1))), np.int64)
            unknown = np.flatnonzero(at < 0)
            h = np.array([hashed(own[i]) for i in unknown.tolist()], np.int64)
            out = np.empty(len(own), np.uint16)
            known = at >= 0
            out[known] = entry[at[known]]
            out[unknown] = 1 + OWN + (h & (SHARED - 1))
            return out, float(part[at[known]].sum()), h

        return encode


def vocabulary(counts: DataFrame, listed: int = LISTED, own: int = OWN) -> Vocabulary:
    """The most frequent words, ``listed`` at most, cut at a sixteenth of an octave of their counts."""
    octave = F.floor(F.log2("n") * 16).cast("int")
    sizes = counts.groupBy(octave.alias("k")).count().collect()  # 1024 rows at most
    least, held = 1 << 30, 0
    for r in sorted(sizes, reverse=True):
        held += r["count"]
        if held > listed:
            break
        least = r["k"]
    top = sorted(counts.where(octave >= least).select("w", "n").collect(), key=lambda r: (-r["n"], bytes(r["w"])))  # ``listed`` rows at most
    names, n = [bytes(r["w"]) for r in top], np.array([r["n"] for r in top], np.float64)
    low = np.array([hashed(w) & (SHARED - 1) for w in names], np.int64)
    entry = np.where(np.arange(len(names)) < own, 1 + np.arange(len(names)), 1 + OWN + low)
    totals = np.zeros(CLASSES * WIDTH)
    for r in counts.groupBy(F.pmod("h", F.lit(SHARED)).alias("k")).agg(F.sum("n").alias("n")).collect():  # SHARED rows
        totals[1 + OWN + r["k"]] = r["n"]
    np.subtract.at(totals, 1 + OWN + low[:own], n[:own])
    totals[1 : 1 + min(own, len(names))] = n[:own]
    return Vocabulary(names, entry, np.log(n / totals[entry]), totals)


class Network:
    """Weights in one vector; ``view`` names its parts."""

    SHAPES = {"T": (len(_PLACES), CLASSES * WIDTH, HIDDEN), "b": (HIDDEN,), "C": (HIDDEN, CLASSES), "c": (CLASSES,), "W": (CLASSES, HIDDEN, WIDTH), "w": (CLASSES, WIDTH)}

    def __init__(self, flat: np.ndarray) -> None:
        self.flat, at = flat, 0
        self.view = {}
        for name, shape in self.SHAPES.items():
            n = int(np.prod(shape))
            self.view[name] = flat[at : at + n].reshape(shape)
            at += n

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(s)) for s in cls.SHAPES.values())

    @classmethod
    def fresh(cls, totals: np.ndarray) -> Network:
        """Small random weights, and biases that give each entry its share of all tokens."""
        net = cls(np.random.default_rng(1).normal(0, 0.05, cls.size()).astype(np.float32))
        share = ((totals + 0.5) / (totals + 0.5).sum()).reshape(CLASSES, WIDTH)
        net.view["b"][:] = 0
        net.view["c"][:] = np.log(share.sum(axis=1))
        net.view["w"][:] = np.log(share / share.sum(axis=1, keepdims=True))
        return net

    def _outputs(self, tokens: np.ndarray, at: np.ndarray) -> dict:
        """The exponentials of all logits at the places ``at``, class by class, with their sums.

        The hidden layer has a last column of ones, so that a product adds the biases, and in ``learn`` sums their gradients.
        """
        v = self.view
        y = tokens[at].astype(np.int64)
        order = np.argsort((y // WIDTH).astype(np.uint8), kind="stable")  # the places of a class stand together from here on
        at, y = at[order], y[order]
        group, inner = np.divmod(y, WIDTH)
        ends = np.searchsorted(group, np.arange(CLASSES + 1))
        x = [tokens[at + p] for p in _PLACES]
        h = v["T"][0].take(x[0], axis=0)  # rows by take: a third of the time of an index
        for k in range(1, len(_PLACES)):
            h += v["T"][k].take(x[k], axis=0)
        h += v["b"]
        h1 = np.ones((len(at), HIDDEN + 1), np.float32)
        np.tanh(h, out=h1[:, :HIDDEN])
        pc = h1 @ np.concatenate([v["C"], v["c"][None]])
        np.exp(pc, out=pc)  # |h| <= 1, so this stays in range
        w1 = np.concatenate([v["W"], v["w"][:, None]], axis=1)
        pw = np.empty((len(at), WIDTH), np.float32)
        for g in range(CLASSES):
            a, z = ends[g], ends[g + 1]
            if a < z:
                np.matmul(h1[a:z], w1[g], out=pw[a:z])
        np.exp(pw, out=pw)
        sc, sw = pc @ np.ones(CLASSES, np.float32), pw @ np.ones(WIDTH, np.float32)
        return {"order": order, "x": x, "h1": h1, "pc": pc, "pw": pw, "sc": sc, "sw": sw, "group": group, "inner": inner, "ends": ends}

    def forward(self, tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, dict]:
        """Log probabilities of the entries at the places ``at``, and what they were made of."""
        s = self._outputs(tokens, at)
        n = np.arange(len(at))
        logp = np.empty(len(at))
        logp[s["order"]] = np.log(np.maximum(s["pc"][n, s["group"]] / s["sc"], 1e-30)) + np.log(np.maximum(s["pw"][n, s["inner"]] / s["sw"], 1e-30))
        return logp, s

    def learn(self, tokens: np.ndarray, at: np.ndarray, squares: Network, rate: float = 0.1) -> None:
        """One Adagrad step on the places ``at``; of the tables only the rows met are touched."""
        s = self._outputs(tokens, at)
        v, q = self.view, squares.view
        n, share = np.arange(len(at)), np.float32(1 / len(at))
        dc, dw, h1 = s["pc"], s["pw"], s["h1"]
        dc /= s["sc"][:, None]
        dw /= s["sw"][:, None]
        dc[n, s["group"]] -= 1
        dw[n, s["inner"]] -= 1
        dc *= share
        dw *= share
        dh = dc @ v["C"].T
        gw = np.zeros((CLASSES, HIDDEN + 1, WIDTH), np.float32)
        for k in range(CLASSES):
            a, z = s["ends"][k], s["ends"][k + 1]
            if a < z:
                dh[a:z] += dw[a:z] @ v["W"][k].T
                np.matmul(h1[a:z].T, dw[a:z], out=gw[k])
        gc = h1.T @ dc
        h = h1[:, :HIDDEN]
        dh *= 1 - h * h
        for name, g in (("C", gc[:HIDDEN]), ("c", gc[HIDDEN]), ("b", np.ones(len(at), np.float32) @ dh), ("W", gw[:, :HIDDEN]), ("w", gw[:, HIDDEN])):
            q[name][...] += g * g
            v[name][...] -= rate * g / (np.sqrt(q[name]) + 1e-6)
            # so no logit passes 3 * HIDDEN + 12 = 84, and exp(84) is a float
            np.clip(v[name], *((-3, 3) if name in "CW" else (-12, 12)), out=v[name])
        for k, x in enumerate(s["x"]):
            order = np.argsort(x, kind="stable")
            own = x.take(order)
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            rows = own.take(first)
            # two columns at a time, as one complex number
            g = np.add.reduceat(dh.take(order, axis=0).view(np.complex64), first, axis=0).view(np.float32)
            total = q["T"][k].take(rows, axis=0) + g * g
            q["T"][k][rows] = total
            v["T"][k][rows] = np.clip(v["T"][k].take(rows, axis=0) - rate * g / (np.sqrt(total) + 1e-6), -12, 12)


def padded(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all documents in a row, two paddings before each and after the last, and the places of the real ones."""
    gap = np.full(2, PAD, np.uint16)
    tokens = np.concatenate([p for d in docs for p in (gap, d)] + [gap])
    lengths = np.array([len(d) for d in docs], np.int64)
    places = np.arange(int(lengths.sum())) + np.repeat(2 * np.arange(1, len(docs) + 1), lengths)
    return tokens, places


def parts(batches: Iterator[pd.DataFrame], most: int = _PART) -> Iterator[pd.DataFrame]:
    """The rows in their order, in runs of ``most`` tokens or the row with which they pass that; not as the batches happen to be cut."""
    held: list[pd.DataFrame] = []
    size = 0
    for b in batches:
        total = size + np.cumsum(b["tokens"].map(len).to_numpy(np.int64) // 2)
        begin = 0
        while (k := int(np.searchsorted(total, most))) < len(total):
            held.append(b.iloc[begin : k + 1])
            yield pd.concat(held)
            held, begin = [], k + 1
            total = total - total[k]
            total[: k + 1] = -1
        held.append(b.iloc[begin:])
        size = int(total[-1]) if len(total) and begin < len(b) else 0 if begin else size
    if sum(map(len, held)):
        yield pd.concat(held)


def _entries(column: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint16) for x in column]


def encode(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """(_row, shard, doc_id, tokens, part, rare) of all documents, one shard to a partition and in order there, written to the checkpoint folder."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = shared.value.encoder()
        for b in batches:
            out = [code(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "tokens": [x[0].tobytes() for x in out], "part": [x[1] for x in out], "rare": [x[2] for x in out]})

    kind = docs.schema[id_col].dataType.simpleString()
    coded = in_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).mapInPandas(run, f"doc_id {kind}, tokens binary, part double, rare array<long>")
    shards = max(1, min(SHARDS, -(-vocab.tokens // shard)))
    order = F.xxhash64("doc_id", "tokens")
    dealt = coded.withColumn("_at", order).withColumn("shard", F.pmod("_at", F.lit(shards)).cast("int"))
    dealt = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("_at", "doc_id", "tokens")
    return checkpointed(dealt.select(F.monotonically_increasing_id().alias("_row"), "shard", "doc_id", "tokens", "part", "rare"))


def train(encoded: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> Network:
    """The network after ``rounds`` rounds over ``encoded``."""
    spark, net = encoded.sparkSession, Network.fresh(vocab.totals)
    shards = encoded.rdd.getNumPartitions()
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(net.flat)

        def run(batches: Iterator[pd.DataFrame], turn: int = turn) -> Iterator[pd.DataFrame]:
            flat = shared.value
            own, squares, seen, shard = Network(flat.copy()), Network(np.full(len(flat), 1e-6, np.float32)), 0, 0
            for part in parts(batches):
                shard = int(part["shard"].iloc[0])
                tokens, places = padded(_entries(part["tokens"]))
                at = np.random.default_rng(3).permutation(places[turn::rounds])
                step = max(256, min(BATCH, len(at) // 64))
                for k in range(0, len(at), step):
                    own.learn(tokens, at[k : k + step], squares)
                seen += len(at)
            if seen:
                chunks = range(0, len(flat), _CHUNK)
                yield pd.DataFrame({"chunk": range(len(chunks)), "shard": shard, "n": float(seen), "x": [own.flat[c : c + _CHUNK].astype(np.float64) * seen for c in chunks]})

        def add(b: pd.DataFrame) -> pd.DataFrame:
            b = b.sort_values("shard")
            return pd.DataFrame({"chunk": b["chunk"].iloc[:1], "shard": b["shard"].iloc[:1] // _FAN, "n": [b["n"].sum()], "x": [np.sum(np.stack(b["x"].to_list()), axis=0)]})

        schema = "chunk int, shard int, n double, x array<double>"
        copies, left = in_batches(encoded.select("shard", "tokens")).mapInPandas(run, schema), shards
        while left > 1:
            copies = copies.groupBy("chunk", F.floor(F.col("shard") / F.lit(_FAN))).applyInPandas(add, schema)
            left = -(-left // _FAN)
        rows = sorted(copies.collect(), key=lambda r: r["chunk"])  # one network
        if rows:
            net = Network(np.concatenate([np.array(r["x"]) / r["n"] for r in rows]).astype(np.float32))
    return net


def score(encoded: DataFrame, counts: DataFrame, vocab: Vocabulary, net: Network) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood), one row per row of ``encoded``."""
    shared = encoded.sparkSession.sparkContext.broadcast(net.flat)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Network(shared.value)
        for b in parts(batches):
            docs = _entries(b["tokens"])
            tokens, at = padded(docs)
            logp = np.empty(len(at), np.float64)
            for k in range(0, len(at), _SLICE):
                logp[k : k + _SLICE] = own.forward(tokens, at[k : k + _SLICE])[0]
            lengths = np.array([len(d) for d in docs])
            total = np.bincount(np.repeat(np.arange(len(docs)), lengths), logp, minlength=len(docs))
            yield pd.DataFrame({"_row": b["_row"], "doc_id": b["doc_id"], "n_tokens": lengths, "sum": total + b["part"].to_numpy()})

    kind = encoded.schema["doc_id"].dataType.simpleString()
    net_part = in_batches(encoded.select("_row", "doc_id", "tokens", "part")).mapInPandas(run, f"_row long, doc_id {kind}, n_tokens long, sum double")
    of_entry = encoded.sparkSession.createDataFrame([(k, float(n)) for k, n in enumerate(vocab.totals[1 + OWN :]) if n > 0], "k long, total double")  # an entry of own words only has none
    known = counts.join(F.broadcast(of_entry), F.pmod("h", F.lit(SHARED)) == F.col("k")).select(F.col("h").alias("_h"), F.log(F.col("n") / F.col("total")).alias("_log"))
    rare = encoded.select("_row", F.explode("rare").alias("_rare")).join(known, F.col("_rare") == F.col("_h"))
    rare = rare.groupBy(F.col("_row").alias("_r")).agg(F.sum("_log").alias("_words"))
    whole = F.col("sum") + F.coalesce("_words", F.lit(0.0))
    mean = F.when(F.col("n_tokens") > 0, whole / F.col("n_tokens"))
    return net_part.join(rare, F.col("_row") == F.col("_r"), "left").select("doc_id", "n_tokens", whole.alias("log_likelihood"), mean.alias("mean_log_likelihood"))


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """Count, encode, train and score: the whole operator over ``docs``."""
    counts = word_counts(docs, text_col)
    vocab = vocabulary(counts)
    encoded = encode(docs, vocab, id_col, text_col, shard)
    return score(encoded, counts, vocab, train(encoded, vocab))
