"""SimHash near-duplicates: fingerprints, vantage-point shards, exact pairs, components.

Fingerprints. Words are runs of anything but ASCII white space after lower-casing A-Z; shingles are
``shingle`` words joined by single spaces, repeats counted (a text with fewer words is one shingle, one
without words has fingerprint 0); a bit is set if it is set in over half the shingles' XXH64 (seed 42).

Pairs. Two fingerprints within ``radius`` = 3 bits differ in at most one bit in their upper or their lower
32-bit half. So there is one forest of vantage points for each half, with distances measured in that
half and a search radius of 1, and a candidate counts if the whole distance is at most 3. This keeps
the overlaps small: a vantage point parts fingerprints into d <= m and d > m, and only those with d = m have to be shown
to the far side as guests (a pair over the boundary needs one of its two ends shown).
The upper levels of each tree are grown on a bounded sample of distinct fingerprints, those below it draw their points by a hash, as many levels as
shards of bounded size take; they route all fingerprints to shards, and each shard goes on dividing what it got, with vantage points of its own, pruned by the
triangle bound, down to leaves in which all home-home and home-guest distances are computed. All pairs
are found; the sample decides only how even the shards are.

Groups. Equal fingerprints are one node, named by its smallest doc_id. A shard joins what it has found by
union-find and gives the connected sets as trees of bounded degree instead of all pairs, so a
group of k fingerprints makes at most k - 1 rows per shard. Components are then found over those edges by alternating
large-star and small-star steps.

``simhash_dedup`` drops near copies by the similarity of their five-word shingles. As the fingerprints of such texts differ in more
bits than Hamming search can reach, MinHash bands give candidates beside the fingerprints, and all are decided by the exact similarity:
every pair that shares a band or a fingerprint component and that no chain of links found before joins.

Defined cases: null texts have no words (fingerprint 0, linked like any other); ties and repeated rows
share a node; a fingerprint that only rows without an id have gets a null component_id; very long texts are shingled whole; an empty table gives an empty result; extra columns are not read by ``simhash_components`` and all
kept by ``simhash_dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, in_batches, join_hot, lean, small_side, unit_hash
from .components import connected_components, tree_edges

RADIUS = 3
SAMPLE = 65_536  # distinct fingerprints that the upper levels of the trees are grown on, at most
SHARD = 16_384  # home fingerprints meant for a shard
LEAF = 256  # home fingerprints in a leaf
_MASKS = (np.uint64(0xFFFFFFFF00000000), np.uint64(0x00000000FFFFFFFF))


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of the text's word shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(words) - shingle + 1
    if n <= 0:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else [], np.uint64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(g, 42) for g in grams), np.uint64, n)


def majority(h: np.ndarray) -> int:
    """The number whose bits are set where over half of the hashes have them set."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):  # 4 MB of bits at a time
        part = h[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big") if len(h) else 0


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of one text."""
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row as a signed 64-bit number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": fp})

    kind = docs.schema[id_col].dataType.simpleString()
    return in_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).mapInPandas(lean(run), f"doc_id {kind}, fp long")


# --- vantage-point trees -------------------------------------------------------------------------


def _far(fps: np.ndarray, point: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((fps ^ point) & mask)


def grow(sample: np.ndarray, mask: np.uint64, depth: int) -> list[tuple[int, int]]:
    """The upper levels of a tree in heap order: (vantage point, m) per node; m = -1 where there is nothing to part."""
    rng = np.random.default_rng(5)
    nodes: list[tuple[int, int]] = [(0, -1)] * ((1 << depth) - 1)
    todo = [(0, sample)]
    while todo:
        at, pts = todo.pop()
        if at >= len(nodes) or len(pts) < 2:
            continue
        point, m = _vantage(pts, mask, rng)
        nodes[at] = (int(point), m)
        if m >= 0:
            near = _far(pts, point, mask) <= m
            todo += [(2 * at + 1, pts[near]), (2 * at + 2, pts[~near])]
    return nodes


def _vantage(pts: np.ndarray, mask: np.uint64, rng: np.random.Generator) -> tuple[np.uint64, int]:
    """A vantage point out of a few that parts ``pts`` evenly with few of them on the boundary; m = -1 if none parts them."""
    best = (1e18, np.uint64(0), -1)
    for point in pts[rng.integers(0, len(pts), 3)]:
        count = np.bincount(_far(pts, point, mask), minlength=65)
        inside = np.cumsum(count)
        for m in np.flatnonzero((inside > 0) & (inside < len(pts))):
            cost = max(inside[m], len(pts) - inside[m]) / len(pts) + count[m] / len(pts)
            if cost < best[0]:
                best = (cost, point, int(m))
    return best[1], best[2]


def _drawn(at: int) -> tuple[np.uint64, int]:
    """The vantage point of a node below the grown ones: a number drawn by the node's place, which parts what is spread evenly at its middle."""
    return np.uint64(xxhash.xxh64_intdigest(at.to_bytes(8, "little"), 42)), 15


def route(fps: np.ndarray, nodes: list[tuple[int, int]], mask: np.uint64, radius: int = 1, depth: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, shard, home) of every visit: each fingerprint at home in one shard and a guest in those behind its boundaries.

    ``depth`` levels lead to the shards, those of ``nodes`` first.
    """
    out = []
    inner = len(nodes) if depth is None else (1 << depth) - 1
    todo = [(0, np.arange(len(fps)), np.ones(len(fps), bool))]
    while todo:
        at, idx, home = todo.pop()
        if not len(idx):
            continue
        if at >= inner:
            out.append((idx, np.full(len(idx), at - inner, np.int64), home))
            continue
        point, m = nodes[at] if at < len(nodes) else _drawn(at)
        (i1, h1), (i2, h2) = _part(fps, idx, home, np.uint64(point), m, mask, radius)
        todo += [(2 * at + 1, i1, h1), (2 * at + 2, i2, h2)]
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return tuple(np.concatenate(x) for x in zip(*out))


def _part(fps, idx, home, point, m, mask, radius):
    """The visits on either side of a boundary; of home visits only the inner side is shown to the outer one."""
    d = _far(fps[idx], point, mask).astype(np.int16)
    near = d <= m
    guest_in = ~home & (d <= m + radius)
    guest_out = ~home & (d > m - radius) | home & near & (d > m - radius)
    inner, outer = home & near | guest_in, home & ~near | guest_out
    return (idx[inner], home[inner]), (idx[outer], home[outer] & ~near[outer])


def shard_links(fps: np.ndarray, home: np.ndarray, mask: np.uint64, radius: int = RADIUS, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (a, b) that connect what lies within ``radius`` in one shard: home-home and home-guest.

    Not all pairs are returned, but all that are needed to connect whatever a pair connects.
    """
    rng = np.random.default_rng(7)
    label = np.arange(len(fps))  # of each fingerprint; labels are joined by union-find
    parent = list(range(len(fps)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    todo = [(np.arange(len(fps)), home.copy())]
    while todo:
        idx, h = todo.pop()
        n = int(h.sum())
        if not n or len(idx) < 2:
            continue
        point, m = _vantage(fps[idx[h]], mask, rng) if n > leaf else (np.uint64(0), -1)
        if m >= 0:
            todo += _part(fps, idx, h, point, m, mask, 1)
            continue
        own = idx[h]
        for at in range(0, n, 256):  # blocks of at most 256 x 16384 distances
            rows = own[at : at + 256]
            for to in range(0, len(idx), 16_384):
                cols = idx[to : to + 16_384]
                near = np.bitwise_count(fps[rows, None] ^ fps[None, cols]) <= radius
                for k in np.flatnonzero(near.any(axis=1)):
                    met = np.append(cols[near[k]], rows[k])
                    labels = label[met]
                    if (labels == labels[0]).all():
                        continue
                    roots = {root(x) for x in np.unique(labels).tolist()}
                    least = min(roots)
                    for x in roots:
                        parent[x] = least
                    label[met] = least
    return tree_edges(np.array([root(x) for x in label.tolist()], np.int64))


def links(nodes: DataFrame, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """(src, dst) edges between node ids of ``nodes`` (fp, node), connecting all fingerprints within ``RADIUS`` bits."""
    spark = nodes.sparkSession
    n = nodes.count()
    depth = max(0, (max(1, n) // shard).bit_length())  # grows with the fingerprints, so that shards do not
    grown = min(depth, max(0, (sample // 16).bit_length() - 1))
    some = nodes if n <= sample else nodes.where(unit_hash(F.col("fp"), 23) < sample / n)
    points = np.array([r[0] for r in some.select("fp").collect()], np.int64).view(np.uint64)  # ``sample`` at most
    points.sort()
    trees = spark.sparkContext.broadcast([grow(points, mask, grown) for mask in _MASKS])

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fps = b["fp"].to_numpy(np.int64).view(np.uint64)
            for half, mask in enumerate(_MASKS):
                idx, to, home = route(fps, trees.value[half], mask, depth=depth)
                yield pd.DataFrame({"shard": to * 2 + half, "home": home, "fp": fps[idx].view(np.int64), "node": b["node"].to_numpy()[idx]})

    def search(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        node = b["node"].to_numpy()
        src, dst = shard_links(b["fp"].to_numpy(np.int64).view(np.uint64), b["home"].to_numpy(bool), _MASKS[int(key[0]) % 2])
        return pd.DataFrame({"src": node[src], "dst": node[dst]})

    spread = nodes.mapInPandas(lean(visits), "shard long, home boolean, fp long, node long")
    return spread.groupBy("shard").applyInPandas(search, "src long, dst long")


def _components(marked: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) from (doc_id, fp)."""
    every = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").cast("long").alias("node"), F.count(F.lit(1)).alias("_n")))
    nodes = every.where("node is not null").drop("_n")
    component = connected_components(checkpointed(links(nodes)))
    label = nodes.join(component, "node").select("fp", "component")
    # nodes outside every link are their own component; one fingerprint may hold a third of all rows
    per = every.join(label, "fp", "left").select("fp", "_n", F.coalesce("component", "node").alias("component_id"))
    n = every.agg(F.sum("_n")).first()[0] or 0
    return join_hot(marked.select("doc_id", "fp"), per, "fp", "_n", n, F.col("doc_id")).select("doc_id", "fp", "component_id")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``; ids are integers."""
    found = _components(checkpointed(fingerprints(docs, id_col, text_col, shingle)))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- near copies by shingle similarity -----------------------------------------------------------
#
# Texts whose sets of five-word shingles have a Jaccard similarity of 0.8 lie 4 to 14 bits apart, where no
# search by Hamming distance prunes anything. Their candidates therefore come from MinHash bands as well.

BANDS, ROWS = 16, 4  # a pair of similarity 0.8 shares none of the bands once in 5000
BLOCK = 128  # members of a bucket that are compared with as many others at a time
_RNG = np.random.default_rng(64)
_FACTORS = _RNG.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def band_keys(hashes: np.ndarray) -> list[int]:
    """One 64-bit key for each band of the MinHash signature of a set of shingle hashes."""
    if not len(hashes):
        return [0]
    least = np.array([(hashes * a + b).min() for a, b in zip(_FACTORS, _SHIFTS)], np.uint64).reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(row.tobytes(), k) - (1 << 63) for k, row in enumerate(least)]


def _marks(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, fp, keys)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hashes = [shingle_hashes(t, shingle) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": np.array([majority(h) for h in hashes], np.uint64).view(np.int64), "keys": [band_keys(h) for h in hashes]})

    return in_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))).mapInPandas(lean(run), "doc_id long, fp long, keys array<long>")


def buckets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """(key, doc_id), distinct: each document in its fingerprint component and in each of its bands.

    A component and a band whose keys are equal are one bucket, which only adds comparisons.
    """
    marked = checkpointed(_marks(docs.where(F.col(id_col).isNotNull()), id_col, text_col, shingle))
    by_bits = _components(marked).select(F.col("component_id").alias("key"), "doc_id")
    by_bands = marked.select(F.explode("keys").alias("key"), "doc_id")
    both = by_bits.unionByName(by_bands)
    shared = both.groupBy("key").agg(F.min("doc_id").alias("_head"), F.max("doc_id").alias("_last")).where("_head <> _last").drop("_last")
    return checkpointed(both.join(shared, "key").select("key", "doc_id", "_head").distinct())


def _texts(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _text) of the documents ``ids`` (_id)."""
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).join(small_side(ids, 500_000), "_id")
    return texts.groupBy("_id").agg(F.max("_text").alias("_text"))


def _sets(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(_id, digest, grams): the sorted set of shingle hashes of each document of ``members``, and a digest of it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            grams = [np.unique(shingle_hashes(t, shingle)).tobytes() for t in b["_text"]]
            yield pd.DataFrame({"_id": b["_id"], "digest": [xxhash.xxh3_128_digest(g) for g in grams], "grams": grams})

    ids = checkpointed(members.select(F.col("doc_id").alias("_id")).distinct())
    return checkpointed(in_batches(_texts(docs, ids, id_col, text_col)).mapInPandas(lean(run), "_id long, digest binary, grams binary"))


def _head_links(members: DataFrame, sets: DataFrame, least: float, piece: int = 512) -> DataFrame:
    """(src, dst): each document with the smallest id of each of its buckets, if they are near.

    The documents that point to a head are dealt into pieces of about ``piece``, each of which gets the head's set once: a head of very many is no hot key.
    """
    pairs = checkpointed(members.select(F.col("doc_id").alias("a"), F.col("_head").alias("b")).where("a <> b").distinct())
    pieces = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / F.lit(piece)).alias("_k"))
    heads = pieces.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1))).select(F.col("b").alias("id"), "b", "part", F.lit(0).alias("side"))
    own = pairs.join(pieces, "b").select(F.col("a").alias("id"), "b", F.pmod(F.xxhash64("a"), F.col("_k")).alias("part"), F.lit(1).alias("side"))
    visits = heads.unionByName(own).join(sets.select(F.col("_id").alias("id"), "grams"), "id")
    visits = visits.select("b", "part", "side", "id", "grams").repartition("b", "part").sortWithinPartitions("b", "part", "side")

    def like(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head = np.empty(0, np.uint64)
        for p in batches:
            out = []
            for b, side, i, grams in zip(p["b"], p["side"], p["id"], p["grams"]):
                own = np.frombuffer(grams, np.uint64)
                if side == 0:
                    head = own
                    continue
                common = len(np.intersect1d(own, head, assume_unique=True))
                if common >= least * (len(own) + len(head) - common):
                    out.append((i, b))
            yield pd.DataFrame(out, columns=["src", "dst"], dtype="int64")

    return in_batches(visits).mapInPandas(lean(like), "src long, dst long")


def block_links(left: list[np.ndarray], right: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (of ``left``, of ``right``) of sorted sets whose Jaccard similarity is ``least`` or more."""
    sizes = np.array([len(x) for x in left + right])
    every, column = np.unique(np.concatenate(left + right), return_inverse=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    met = np.bincount(column, minlength=len(every)) > 1  # what one set alone has is common to no two
    row, column = row[met[column]], (np.cumsum(met) - 1)[column[met[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(left), len(right)), np.float64)
    for at in range(0, int(met.sum()), 4096):
        a, z = np.searchsorted(column, [at, at + 4096])
        has = np.zeros((len(sizes), 4096), np.float32)
        has[row[a:z], column[a:z] - at] = 1
        common += has[: len(left)] @ has[len(left) :].T
    return np.nonzero(common >= least * (sizes[: len(left), None] + sizes[None, len(left) :] - common))


def _pair_links(members: DataFrame, label: DataFrame, found: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """(src, dst): links that join what is near within a bucket and not yet joined by ``label`` (node, component).

    Every pair of a bucket is compared, except those of one component and those compared with the head before. Equal sets are one
    member. A bucket is dealt into blocks of about ``block`` members, a component that fills a block into
    blocks of its own, and each pair of blocks is one piece of work.
    """
    label = label.select(F.col("node").alias("doc_id"), "component")
    labelled = checkpointed(members.join(label, "doc_id", "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("c")))
    # in a bucket of two the only pair has been compared; of buckets with equal members one is enough
    seal = [F.sum(F.xxhash64("doc_id", F.lit(k)).cast("decimal(38,0)")).alias(f"_s{k}") for k in (1, 2)]
    kinds = labelled.groupBy("key").agg(F.count(F.lit(1)).alias("_n"), F.min("c").alias("_lo"), F.max("c").alias("_hi"), *seal)
    mixed = kinds.where("_n > 2 and _lo <> _hi").groupBy("_n", "_s1", "_s2").agg(F.min("key").alias("key")).select("key")
    open_ = checkpointed(labelled.join(mixed, "key"))

    ids = open_.select(F.col("doc_id").alias("_id")).distinct()
    found = found.join(ids, "_id", "left_semi")
    first = found.groupBy("digest").agg(F.min("_id").alias("rep"))
    same = checkpointed(found.select("_id", "digest").join(first, "digest").select(F.col("_id").alias("doc_id"), "rep"))
    reps = open_.join(same, "doc_id").select("key", F.col("rep").alias("id")).distinct()
    reps = reps.join(label.withColumnRenamed("doc_id", "id"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("c"))
    reps = checkpointed(reps)
    sizes = reps.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"))
    pool = sizes.groupBy("key").agg(F.sum(F.when(F.col("n") < block, F.col("n"))).alias("pool"))
    sizes = sizes.join(pool, "key")
    big = F.col("n") >= block
    slot = F.pmod(F.xxhash64("id", F.lit(3)), F.ceil(F.when(big, F.col("n")).otherwise(F.col("pool")) / block))
    dealt = checkpointed(reps.join(sizes, ["key", "c"]).select("key", "id", "c", F.xxhash64(F.when(big, F.col("c")), slot).alias("blk")))

    blocks = checkpointed(dealt.groupBy("key", "blk").agg(F.min("c").alias("lo"), F.max("c").alias("hi")))
    one = blocks.select("key", F.col("blk").alias("i"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    two = blocks.select("key", F.col("blk").alias("j"), F.col("lo").alias("_lo2"), F.col("hi").alias("_hi2"))
    work = checkpointed(one.join(two, "key").where("i <= j and least(_lo, _lo2) <> greatest(_hi, _hi2)").select("key", "i", "j"))
    left = work.join(dealt.withColumnRenamed("blk", "i"), ["key", "i"]).withColumn("side", F.lit(0))
    right = work.where("i <> j").join(dealt.withColumnRenamed("blk", "j"), ["key", "j"]).withColumn("side", F.lit(1))
    visits = left.unionByName(right).join(found.select(F.col("_id").alias("id"), "grams"), "id")
    visits = visits.select("key", "i", "j", "side", "id", "c", "grams").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")

    def near(piece: list[tuple]) -> list[tuple[int, int]]:
        halves = [[(x, c, np.frombuffer(g, np.uint64)) for side, x, c, g in piece if side == k] for k in (0, 1)]
        halves[1] = halves[1] or halves[0]
        a, b = block_links([m[2] for m in halves[0]], [m[2] for m in halves[1]], least)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        out = []
        for p, q in zip(a.tolist(), b.tolist()):
            (x, cx, _), (y, cy, _) = halves[0][p], halves[1][q]
            rx, ry = root(cx), root(cy)
            if rx != ry:
                parent[rx] = ry
                out.append((x, y))
        return out

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, piece = None, []
        for b in batches:
            out = []
            for key, i, j, *member in zip(*(b[k] for k in ("key", "i", "j", "side", "id", "c", "grams"))):
                if at != (key, i, j):
                    out += near(piece) if piece else []
                    at, piece = (key, i, j), []
                piece.append(tuple(member))
            yield pd.DataFrame(out, columns=["src", "dst"], dtype="int64")
        if piece:
            yield pd.DataFrame(near(piece), columns=["src", "dst"], dtype="int64")

    links = in_batches(visits).mapInPandas(lean(compare), "src long, dst long")
    return links.unionByName(same.where("doc_id <> rep").select(F.col("doc_id").alias("src"), F.col("rep").alias("dst")))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """(doc_id, group_id) of the documents that a chain of near links joins with others, group_id their smallest doc_id.

    Two documents are linked if they share a bucket and their sets of word shingles have a Jaccard similarity of ``least`` or more. A text of
    fewer words is one shingle; texts without words are equal to one another. Heads come first: what they join
    need not be compared again, so that a large group of copies costs little.
    """
    members = buckets(docs, id_col, text_col, shingle)
    sets = _sets(docs, members, id_col, text_col, shingle)
    found = checkpointed(connected_components(checkpointed(_head_links(members, sets, least))))
    more = checkpointed(_pair_links(members, found, sets, least))
    if not more.isEmpty():
        found = connected_components(found.select(F.col("node").alias("src"), F.col("component").alias("dst")).unionByName(more))
    return found.select(F.col("node").alias("doc_id"), F.col("component").alias("group_id"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near copies the one with the smallest id; rows with a null id stay."""
    gone = checkpointed(near_groups(docs, id_col, text_col, shingle, least).where("doc_id <> group_id").select(F.col("doc_id").alias("_sd_gone")))
    return docs.join(small_side(gone, 500_000), F.col(id_col) == F.col("_sd_gone"), "left_anti").select(*docs.columns)
