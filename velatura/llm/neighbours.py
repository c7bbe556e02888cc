"""Exact nearest neighbours by largest inner product: a block matrix join over int8 tiles.

Vectors are coded once: int8 codes (each vector scaled by its own largest component), scale and the lengths of what is coded, of the error and of
the original. A task takes a block of queries and a stripe of candidates. For each tile it multiplies the codes and bounds the true inner product from both sides,

    q.c = q^.c^ + q^.ec + eq.c,   |q.c - q^.c^| <= |q^| |ec| + |eq| |c|

(x^ is what the codes stand for, ex = x - x^). A pair can be among the k nearest only if its upper
bound reaches the k-th best lower bound of the query, first within the stripe, then over all stripes; the pairs that do fetch their originals, are
computed in double precision and ranked. No pair is lost, so recall is 1.

Scale. The work is queries x candidates, as the task asks; the codes of either side are copied once for every block or
stripe of the other, the originals once for every surviving pair, little more than k a query. No side is broadcast or collected.

Defined cases: vectors that are null, all zero or hold a null or non-finite component take no part, nor do rows without an id; vectors of
different lengths are not compared; ties go to the smaller id; a query's own row is left out by its number, so other rows that repeat its id are
candidates, and each row that repeats a query's id is a query of its own; fewer candidates than k give fewer rows; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

QUERY_BLOCK = 1024
STRIPE = 32_768  # candidates meant for a stripe
_TILE = 4096


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not all zero."""
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(finite & F.exists(v, lambda x: F.coalesce(x != 0.0, F.lit(False))), F.lit(False))


def _codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes as float32 (whole numbers of at most 127), scales, norms of the coded and of the error vectors.

    int8 codes multiply exactly in float32 while dim * 127**2 stays under 2**24 (1040 dimensions), and far faster there.
    """
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale == 0] = 1.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.sqrt((coded**2).sum(axis=1)), np.sqrt(((x - coded) ** 2).sum(axis=1))


class Heaps:
    """What may be among the k best candidates of each query of a block, by bounds: (query, row, lower, upper)."""

    def __init__(self, rows: np.ndarray, codes: np.ndarray, scale: np.ndarray, norm: np.ndarray, error: np.ndarray, k: int) -> None:
        self.rows, self.codes, self.scale, self.norm, self.error, self.k = rows, codes, scale, norm, error, k
        self.floor = np.full(len(rows), -np.inf)  # the k-th best lower bound met
        self.best = np.full((len(rows), k), -np.inf)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def meet(self, rows: np.ndarray, codes: np.ndarray, scale: np.ndarray, error: np.ndarray, whole: np.ndarray) -> None:
        """One tile of candidates, ``whole`` being the lengths of the originals."""
        kind = np.float32 if codes.shape[1] * 127 * 127 < 1 << 24 else np.float64
        product = (self.codes.astype(kind) @ codes.astype(kind).T) * self.scale[:, None] * scale[None, :]
        # a hair more for the rounding of the bounds themselves
        spread = (self.norm[:, None] * error[None, :] + self.error[:, None] * whole[None, :]) * (1 + 1e-9) + 1e-12 * (1 + np.abs(product))
        own = self.rows[:, None] == rows[None, :]
        low = np.where(own, -np.inf, product - spread)
        k = min(self.k, low.shape[1])
        self.best = np.partition(np.concatenate([self.best, np.partition(low, low.shape[1] - k, axis=1)[:, -k:]], axis=1), k, axis=1)[:, -self.k :]
        self.floor = self.best.min(axis=1)
        q, c = np.nonzero((product + spread >= self.floor[:, None]) & ~own)
        self.held.append((q, rows[c], low[q, c], (product + spread)[q, c]))
        self.size += len(q)
        if self.size > max(1 << 20, 8 * self.best.size):
            self.held = [self.survivors()]
            self.size = len(self.held[0][0])

    def survivors(self) -> tuple[np.ndarray, ...]:
        if not self.held:
            return (np.empty(0, np.int64),) * 2 + (np.empty(0),) * 2
        q, row, low, high = (np.concatenate(x) for x in zip(*self.held))
        on = high >= self.floor[q]
        return q[on], row[on], low[on], high[on]


_CODED = "codes binary, scale double, norm double, error double, whole double"


def nearest(rows: DataFrame, query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", query_block: int = QUERY_BLOCK, stripe: int = STRIPE) -> DataFrame:
    """(query_id, rank, vec_id, score): of each row for which ``query`` holds the ``k`` nearest other rows."""
    v = F.col(vector_col)
    whole = rows.where(F.col(id_col).isNotNull() & usable(v)).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"), F.coalesce(query, F.lit(False)).alias("asks"))

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, g in b.groupby(b["v"].map(len)):
                x = np.array(g["v"].tolist(), np.float64)
                codes, scale, norm, error = _codes(x)
                yield pd.DataFrame({"row": g["row"], "asks": g["asks"], "dim": dim, "codes": [c.tobytes() for c in codes], "scale": scale, "norm": norm, "error": error, "whole": np.sqrt((x**2).sum(axis=1))})

    # written once, so that the row numbers stay what they are
    whole = checkpointed(whole)
    coded = checkpointed(whole.select("row", "v", "asks").mapInPandas(code, f"row long, asks boolean, dim int, {_CODED}"))
    n = coded.agg(F.sum(F.col("asks").cast("long")), F.count(F.lit(1))).first()
    blocks, stripes = max(1, -(-(n[0] or 0) // query_block)), max(1, -(-n[1] // stripe))
    # a block or stripe is a hash of the row; the other side's codes, an eighth of the vectors, are copied to each
    deal = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n)).cast("int")
    few = ["dim", "row", "codes", "scale", "norm", "error", "whole"]
    q = coded.where("asks").withColumn("qb", deal(blocks, 3)).withColumn("st", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))).select("qb", "st", *few, F.lit(0).alias("side"))
    c = coded.withColumn("st", deal(stripes, 5)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("qb", "st", *few, F.lit(1).alias("side"))
    cells = q.unionByName(c).repartitionById(blocks * stripes, (F.col("qb") * stripes + F.col("st")).cast("int")).sortWithinPartitions("dim", "side", "row")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Queries of a cell come first, its candidates stream by in tiles."""
        key, asked, heaps = None, [], None

        def done() -> pd.DataFrame:
            q, row, low, high = heaps.survivors()
            return pd.DataFrame({"q": heaps.rows[q], "c": row, "low": low, "high": high})

        for b in batches:
            for (dim, side), g in b.groupby(["dim", "side"], sort=True):
                if dim != key:
                    if heaps is not None:
                        yield done()
                    key, asked, heaps = dim, [], None
                if side == 0:
                    asked.append(g)
                    continue
                if heaps is None and asked:
                    own = pd.concat(asked)
                    heaps = Heaps(own["row"].to_numpy(), _matrix(own), own["scale"].to_numpy(), own["norm"].to_numpy(), own["error"].to_numpy(), k)
                for at in range(0, len(g) if heaps else 0, _TILE):
                    t = g.iloc[at : at + _TILE]
                    heaps.meet(t["row"].to_numpy(), _matrix(t), t["scale"].to_numpy(), t["error"].to_numpy(), t["whole"].to_numpy())
        if heaps is not None:
            yield done()

    found = checkpointed(cells.mapInPandas(run, "q long, c long, low double, high double"))
    # across the stripes: a pair stays if its upper bound reaches the k-th best lower bound of its query
    by_low = Window.partitionBy("q").orderBy(F.col("low").desc(), "c")
    floor = found.withColumn("_n", F.row_number().over(by_low)).where(F.col("_n") == k).select(F.col("q").alias("_q"), F.col("low").alias("_floor"))
    pairs = found.join(floor, F.col("q") == F.col("_q"), "left").where("_floor is null or high >= _floor").select("q", "c")
    pairs = pairs.join(whole.where("asks").select(F.col("row").alias("q"), F.col("id").alias("query_id"), F.col("v").alias("qv")), "q")
    pairs = pairs.join(whole.select(F.col("row").alias("c"), F.col("id").alias("vec_id"), F.col("v").alias("cv")), "c")
    # summed from the first component to the last: equal vectors give equal scores
    score = F.aggregate(F.zip_with("qv", "cv", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    ranked = pairs.select("q", "query_id", "vec_id", score.alias("score")).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _matrix(rows: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(rows["codes"]), np.int8).reshape(len(rows), -1)


def recall(found: DataFrame, truth: DataFrame) -> float:
    """Share of the true (query_id, vec_id) pairs that were found."""
    n = truth.count()
    return found.select("query_id", "vec_id").join(truth.select("query_id", "vec_id"), ["query_id", "vec_id"]).distinct().count() / n if n else 1.0
