import math
from collections import Counter

import numpy as np
import pandas as pd

from velatura.llm import lm_score as lm
from velatura.llm.toxicity import words

from .helpers import ODD, prose, table


def test_probabilities_sum_to_one_and_match_a_plain_softmax():
    net = lm.Network.fresh(np.arange(lm.CLASSES * lm.WIDTH, dtype=float))
    r = np.random.default_rng(1)
    net.flat += r.normal(0, 0.3, len(net.flat)).astype(np.float32)
    v = net.view
    around = [3, 9, 500, 77]
    total = 0.0
    tokens = np.array([around[0], around[1], 0, around[2], around[3]])
    every = np.arange(lm.CLASSES * lm.WIDTH)
    for y in every:
        tokens[2] = y
        total += math.exp(net.forward(tokens, np.array([2]))[0][0])
    assert abs(total - 1) < 1e-4
    h = np.tanh(v["b"] + sum(v["T"][k][x] for k, x in enumerate(around)))
    c = np.exp(h @ v["C"] + v["c"])
    g, i = divmod(700, lm.WIDTH)
    w = np.exp(h @ v["W"][g] + v["w"][g])
    tokens[2] = 700
    assert abs(net.forward(tokens, np.array([2]))[0][0] - math.log(c[g] / c.sum() * w[i] / w.sum())) < 1e-4


def test_gradient_lowers_the_loss():
    r = np.random.default_rng(2)
    tokens = np.concatenate([[0, 0], np.tile([5, 900, 33, 410], 300), [0, 0]]).astype(np.uint16)
    at = np.arange(2, len(tokens) - 2)
    net = lm.Network.fresh(np.ones(lm.CLASSES * lm.WIDTH))
    squares = lm.Network(np.full(len(net.flat), 1e-6, np.float32))
    before = net.forward(tokens, at)[0].mean()
    for _ in range(80):
        net.learn(tokens, r.choice(at, 200), squares)
    assert before < -6 and net.forward(tokens, at)[0].mean() > -0.5


def test_gradient_is_that_of_finite_differences():
    r = np.random.default_rng(4)
    tokens = r.integers(0, lm.CLASSES * lm.WIDTH, 60).astype(np.uint16)
    at = np.arange(2, 58)
    net = lm.Network(r.normal(0, 0.3, lm.Network.size()).astype(np.float32))
    seen = lm.Network(np.zeros(lm.Network.size(), np.float32))
    step = lm.Network(net.flat.copy())
    step.learn(tokens, at, seen, rate=0.0)  # squares hold the squared gradient
    for name, place in (("T", (1, int(tokens[7]), 3)), ("b", (2,)), ("C", (4, 5)), ("W", (int(tokens[20]) // lm.WIDTH, 1, 2)), ("w", (int(tokens[20]) // lm.WIDTH, 2))):
        loss = []
        for d in (1e-2, -1e-2):
            other = lm.Network(net.flat.copy())
            other.view[name][place] += d
            loss.append(-other.forward(tokens, at)[0].mean())
        assert abs(abs(loss[0] - loss[1]) / 2e-2 - math.sqrt(seen.view[name][place])) < 2e-3, name


def test_learning_makes_no_log_probabilities(monkeypatch):
    """A step needs the probabilities only; their logarithms at every target were a part of its time."""
    tokens = np.tile([5, 900, 33, 410], 50).astype(np.uint16)
    net, squares = lm.Network.fresh(np.ones(lm.CLASSES * lm.WIDTH)), lm.Network(np.full(lm.Network.size(), 1e-6, np.float32))
    before = net.flat.copy()
    monkeypatch.setattr(lm.Network, "forward", None)
    net.learn(tokens, np.arange(2, 190), squares)
    assert (net.flat != before).any()


def test_the_whole_gradient_matches_a_plain_one():
    r = np.random.default_rng(6)
    tokens = (r.zipf(1.3, 900) % (lm.CLASSES * lm.WIDTH)).astype(np.uint16)  # some entries often, some once
    at = r.permutation(np.arange(2, 898))
    net = lm.Network(r.normal(0, 0.3, lm.Network.size()).astype(np.float32))
    seen, step = lm.Network(np.zeros(lm.Network.size(), np.float32)), lm.Network(net.flat.copy())
    step.learn(tokens, at, seen, rate=0.0)
    v = {k: x.astype(np.float64) for k, x in net.view.items()}
    g = {k: np.zeros_like(x) for k, x in v.items()}
    for i in at:
        near = [int(tokens[i + p]) for p in (-2, -1, 1, 2)]
        h = np.tanh(v["b"] + sum(v["T"][k][x] for k, x in enumerate(near)))
        c, e = divmod(int(tokens[i]), lm.WIDTH)
        dc, dw = np.exp(h @ v["C"] + v["c"]), np.exp(h @ v["W"][c] + v["w"][c])
        dc, dw = dc / dc.sum() / len(at), dw / dw.sum() / len(at)
        dc[c] -= 1 / len(at)
        dw[e] -= 1 / len(at)
        dh = (v["C"] @ dc + v["W"][c] @ dw) * (1 - h * h)
        g["C"] += np.outer(h, dc)
        g["c"] += dc
        g["W"][c] += np.outer(h, dw)
        g["w"][c] += dw
        g["b"] += dh
        for k, x in enumerate(near):
            g["T"][k][x] += dh
    for name, x in g.items():
        assert np.allclose(np.sqrt(seen.view[name]), np.abs(x), rtol=1e-3, atol=1e-6), name


def _rows(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_documents(spark):
    rows = [(i, prose(i, 80), "a") for i in range(60)] + [(70, "stone house of every the", "a"), (71, "qqq zzz xxyy vvw", "a")] + ODD
    docs = table(spark, rows)
    out = _rows(lm.pseudo_likelihood(docs.repartition(3), shard=5000))
    assert sum(map(len, out.values())) == len(rows)
    assert out[900][0]["n_tokens"] == 0 and out[900][0]["log_likelihood"] == 0 and out[900][0]["mean_log_likelihood"] is None
    assert out[905][0]["n_tokens"] == 60_000
    assert out[70][0]["mean_log_likelihood"] > out[71][0]["mean_log_likelihood"]
    assert len({r["log_likelihood"] for r in out[906]}) == 1
    again = _rows(lm.pseudo_likelihood(docs.repartition(7), shard=5000))  # the split of the input changes nothing
    assert all(abs(x["log_likelihood"] - y["log_likelihood"]) <= 1e-6 * max(1, abs(x["log_likelihood"])) for k in out for x, y in zip(out[k], again[k]))


def test_totals_match_a_plain_sum_over_places(spark):
    """With few own and listed words, so that entries are shared and rare words are joined."""
    rows = [(i, prose(i, 40) + f" only{'abcdefgh'[i % 8]} once{'xyz' * i}", "a") for i in range(30)] + ODD
    docs = table(spark, rows).repartition(3)
    counts = lm.word_counts(docs)
    vocab = lm.vocabulary(counts, listed=20, own=6)
    assert 6 < len(vocab.listed) <= 20
    encoded = lm.encode(docs, vocab, shard=500)
    net = lm.train(encoded, vocab)
    plain = Counter(w for _, t, _ in rows for w in words(t))
    own = [w for w, _ in sorted(plain.items(), key=lambda x: (-x[1], x[0]))[:6]]
    entry = {w: 1 + own.index(w) if w in own else 1 + lm.OWN + (lm.hashed(w) & (lm.SHARED - 1)) for w in plain}
    total = Counter()
    for w, n in plain.items():
        total[entry[w]] += n
    v = net.view
    out = _rows(lm.score(encoded, counts, vocab, net))
    for i, text, _ in rows[:30]:
        seq = words(text)
        ids = [0, 0, *(entry[w] for w in seq), 0, 0]
        expected = 0.0
        for at, w in enumerate(seq):
            near = (ids[at], ids[at + 1], ids[at + 3], ids[at + 4])
            h = np.tanh(v["b"] + sum(v["T"][k][x] for k, x in enumerate(near)))
            c = np.exp(h @ v["C"] + v["c"])
            g, e = divmod(entry[w], lm.WIDTH)
            z = np.exp(h @ v["W"][g] + v["w"][g])
            expected += math.log(c[g] / c.sum() * z[e] / z.sum() * plain[w] / total[entry[w]])
        assert abs(out[i][0]["log_likelihood"] - expected) < 1e-3 * abs(expected)


def test_every_word_seen_has_its_part():
    vocab = lm.Vocabulary([b"a", b"b"], np.array([1, 1 + lm.OWN]), np.array([0.0, -1.0]), np.zeros(4))
    entries, part, rare = vocab.encoder()("A b! c")
    assert entries.tolist() == [1, 1 + lm.OWN, 1 + lm.OWN + (lm.hashed(b"c") & (lm.SHARED - 1))] and part == -1.0 and rare.tolist() == [lm.hashed(b"c")]
    entries, part, rare = vocab.encoder()(None)
    assert len(entries) == len(rare) == 0 and part == 0


def test_parts_do_not_hang_on_batches():
    sizes = [3, 9, 1, 0, 4, 20, 1, 1, 2, 0]
    frame = pd.DataFrame({"id": range(len(sizes)), "tokens": [b"xx" * n for n in sizes]})
    cut = lambda *at: [p["id"].tolist() for p in lm.parts(iter([frame.iloc[a:z] for a, z in zip((0, *at), (*at, len(sizes)))]), 10)]
    assert cut() == cut(1) == cut(2) == cut(2, 6) == cut(1, 2, 3, 5, 9) == [[0, 1], [2, 3, 4, 5], [6, 7, 8, 9]]


def test_training_predicts_the_words_of_every_place(spark):
    text = " ".join(f"word{'abcdefghijkl'[i % 12]}" for i in range(48_000))  # a place in twelve has one word only
    docs = table(spark, [(1, text, "a")])
    vocab = lm.vocabulary(lm.word_counts(docs))
    net = lm.train(lm.encode(docs, vocab), vocab)
    tokens, at = lm.padded([vocab.encoder()(text)[0]])
    logp = net.forward(tokens, at[:1200])[0].reshape(-1, 12).mean(axis=0)
    assert logp.min() > -2  # log(1 / 12) = -2.5 before training


def test_empty_corpus(spark):
    assert lm.pseudo_likelihood(table(spark, [])).count() == 0
