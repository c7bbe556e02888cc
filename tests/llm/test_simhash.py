import numpy as np
import pytest
import xxhash

from velatura.llm import simhash
from velatura.llm.components import connected_components, tree_edges

from .helpers import ODD, prose, table


def slow_fingerprint(text, k):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("text", ["", None, "one", "One TWO", "a b c", "Ä a Ä b", "x " * 500, prose(1, 300), " \t lead\ntrail\x0b"])
def test_fingerprint(text):
    for k in (3, 5):
        assert simhash.fingerprint(text, k) == slow_fingerprint(text, k)


def clustered(seed, n):
    """Random fingerprints, each with some that differ in 1 to 5 bits, and dense clusters."""
    r = np.random.default_rng(seed)
    out = []
    for base in r.integers(0, 1 << 63, n, dtype=np.uint64):
        x = np.uint64(base)
        out.append(x)
        for _ in range(int(r.integers(0, 4))):
            for b in r.choice(64, int(r.integers(1, 6)), replace=False):
                x ^= np.uint64(1) << np.uint64(b)
            out.append(x)
    dense = np.uint64(0xF0F0F0F0F0F0F0F0)
    out += [dense ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(j)) for i in range(30) for j in range(i)]
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("seed", [1, 2])
def test_links_connect_exactly_what_brute_force_does(spark, seed):
    fps = clustered(seed, 400)
    near = [(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 3).tolist()]
    want = groups(near, range(len(fps)))
    nodes = spark.createDataFrame([(int(x), i) for i, x in enumerate(fps.view(np.int64).tolist())], "fp long, node long")
    edges = simhash.links(nodes, sample=256, shard=64)
    got = groups([(r["src"], r["dst"]) for r in edges.collect()], range(len(fps)))
    assert got == want
    assert edges.count() <= 4 * len(fps)  # trees, not all pairs
    labels = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert all(labels.get(n, n) == c for n, c in want.items())


def test_small_leaves_find_all_pairs():
    fps = clustered(3, 200)
    for mask in simhash._MASKS:
        a, b = simhash.shard_links(fps, np.ones(len(fps), bool), mask, leaf=8)
        both = groups(zip(a.tolist(), b.tolist()), range(len(fps)))
        for i in range(len(fps)):
            for j in np.flatnonzero((np.bitwise_count(fps[:i] ^ fps[i]) <= 3) & (np.bitwise_count((fps[:i] ^ fps[i]) & mask) <= 1)).tolist():
                assert both[i] == both[j]


def test_tree_edges():
    roots = np.array([0] * 200 + [7] + [9] * 3)
    a, b = tree_edges(roots, fan=4)
    assert len(a) == len(roots) - 3
    assert len(set(groups(zip(a.tolist(), b.tolist()), range(len(roots))).values())) == 3


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (1001, 1002)], "src long, dst long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[1002] == 1001


def test_components_of_documents(spark):
    base = [(i, prose(i, 200), "a") for i in range(1, 30)]
    near = [(100 + i, t.replace("river", "river", 1) + " end", s) for i, t, s in base[:10]]
    rows = [r for r in ODD if r[0] is not None] + base + near
    got = {}
    for r in simhash.simhash_components(table(spark, rows)).collect():
        got[r["doc_id"]] = (int(r["fingerprint"], 16), r["component_id"])
    fp = {i: slow_fingerprint(t, 3) for i, t, _ in rows}
    ids = sorted(fp)
    want = groups([(a, b) for a in ids for b in ids if a > b and (fp[a] ^ fp[b]).bit_count() <= 3], ids)
    assert got == {i: (fp[i], want[i]) for i in ids}
    assert simhash.simhash_components(table(spark, [])).count() == 0


def jaccard(a, b, k=5):
    def grams(t):
        w = t.lower().split()
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())

    x, y = grams(a or ""), grams(b or "")
    return len(x & y) / len(x | y) if x | y else 1.0


def test_filter_drops_near_copies_only(spark):
    words = tuple(f"{a}{b}" for a in ("la", "mo", "ri", "te", "su") for b in ("ne", "ra", "sti", "lo", "mand"))
    base = [(i, prose(i, 100 + 7 * i, words), "a") for i in range(1, 40)]
    copies = []
    for i, t, s in base:
        w = t.split()
        for k in range(i % 6):  # none to five words changed
            w[(k * 37 + i) % len(w)] = f"changed{k}"
        copies.append((200 + i, " ".join(w) + " .", s))
    rows = base + copies + [(500, None, "a"), (501, "", "b"), (502, "two words", "a"), (503, "Two  WORDS", "b"), (504, "two other", "b")]
    docs = table(spark, rows)
    out = simhash.simhash_dedup(docs)
    assert out.columns == docs.columns
    near = [(i, j) for i, t, _ in rows for j, u, _ in rows if i > j and jaccard(t, u) >= 0.8]
    want = {i for i, head in groups(near, [r[0] for r in rows]).items() if i == head}
    assert {r["doc_id"] for r in out.collect()} == want
    assert len(want) < len(rows) - 20


def test_filter_of_odd_rows(spark):
    docs = table(spark, ODD)
    kept = [r["doc_id"] for r in simhash.simhash_dedup(docs).collect()]
    assert sorted(map(str, kept)) == sorted(["None", "900", "903", "904", "905", "906", "906"])
    assert simhash.simhash_dedup(table(spark, [])).count() == 0


def changed(words, places, tag):
    out = list(words)
    for p in places:
        out[p] = f"{tag}x{p}"
    return out


def family(r, tag, pairs, n=300, common=5, own=6):
    """Texts of one template, each with places of its own changed, and for each a copy with a few more changed."""
    base = [f"{tag}w{i}" for i in range(n)]
    out = []
    for k in range(pairs):
        text = changed(base, r.choice(n, common, replace=False), f"{tag}k{k}")
        out += [text, changed(text, r.choice(n, own, replace=False), f"{tag}c{k}")]
    return out


def test_pairs_within_a_bucket_are_found_where_its_head_is_not_near(spark):
    r = np.random.default_rng(12)
    texts = [t for f in range(3) for t in family(r, f"f{f}", 40)]
    chain = [f"chain{i}" for i in range(300)]
    for k in range(25):  # each near the one before only
        chain = changed(chain, range(k * 11, k * 11 + 11, 3), f"v{k}")
        texts.append(chain)
    ids = r.permutation(len(texts)) + 1
    rows = [(int(i), " ".join(t), "a") for i, t in zip(ids, texts)]
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in zip(ids.tolist(), texts)}
    near = [(i, j) for i in sets for j in sets if i > j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = groups(near, list(sets))
    assert 60 < len(set(want.values())) < len(texts) - 60
    kept = {x["doc_id"] for x in simhash.simhash_dedup(table(spark, rows)).collect()}
    assert kept == {i for i, head in want.items() if i == head}


def test_block_links_are_those_of_brute_force():
    r = np.random.default_rng(4)
    sets = [np.unique(r.integers(0, 60, 100).astype(np.uint64)) for _ in range(40)] + [np.empty(0, np.uint64)]
    sets += [np.arange(9000, dtype=np.uint64), np.arange(1000, 9000, dtype=np.uint64)]
    got = set(zip(*(x.tolist() for x in simhash.block_links(sets[:20] + sets[-2:], sets[20:], 0.6))))
    want = set()
    for a, x in enumerate(sets[:20] + sets[-2:]):
        for b, y in enumerate(sets[20:]):
            common = len(np.intersect1d(x, y))
            if common >= 0.6 * (len(x) + len(y) - common):
                want.add((a, b))
    assert got == want and len(want) > 5
