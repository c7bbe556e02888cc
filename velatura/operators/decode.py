"""From logits to labels: averaging over windows, softmax, argmax, BIO-constrained Viterbi."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import taxonomy as tax

FORBIDDEN = -1e4


def softmax(x: Column) -> Column:
    """Shares of an array of numbers, computed stably."""
    top = F.array_max(x)
    powers = F.transform(x, lambda v: F.exp((v - top).cast("double")))
    total = F.aggregate(powers, F.lit(0.0), lambda a, v: a + v)
    return F.transform(powers, lambda v: v / total)


def argmax(x: Column) -> Column:
    """Place, from 0, of the first largest number."""
    return (F.array_position(x, F.array_max(x)) - 1).cast("int")


def mean_logits(logits: DataFrame, keys: list[str], column: str = "logits") -> DataFrame:
    """(…keys, logits): arrays of equal keys averaged place by place (e.g. one token seen in several windows)."""
    places = logits.select(*keys, F.posexplode(column).alias("_place", "_x"))
    mean = places.groupBy(*keys, "_place").agg(F.avg(F.col("_x").cast("double")).alias("_x"))
    return mean.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", "_x"))), lambda s: s["_x"]).alias(column))


def on_grid(found: DataFrame, tokens: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Averaged tokens of windows put on the tokens of the whole text: (matched with tok_idx, tokens or offsets without a partner)."""
    own = [*keys, "start", "end"]
    matched = found.join(tokens.select(*own, "tok_idx"), own)
    lost = found.join(tokens, own, "left_anti").select(*own, F.lit("window_only").alias("side"))
    bare = tokens.join(found, own, "left_anti").select(*own, F.lit("text_only").alias("side"))
    return matched, lost.unionByName(bare)


def transitions(labels: tuple[str, ...] = tax.LABELS) -> np.ndarray:
    """Scores of moving from the row's label to the column's: 0 where allowed, ``FORBIDDEN`` else.

    I goes on from B or I of its type only; labels that are no BIO labels allow nothing, except that O stays O.
    """
    kind = [("O", None) if x == "O" else tuple(x.split("-", 1)) if x[:2] in ("B-", "I-") and len(x) > 2 else None for x in labels]
    out = np.full((len(labels), len(labels)), FORBIDDEN, np.float32)
    for p, a in enumerate(kind):
        for n, b in enumerate(kind):
            if a and b and (b[0] != "I" or a[1] == b[1] and a[0] in ("B", "I")):
                out[p, n] = 0
    return out


def transition_table(spark, labels: tuple[str, ...] = tax.LABELS) -> DataFrame:
    """(prev_id, next_id, score) as a table, by a join of the label list with itself on the rule."""
    dim = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "id int, label string")
    a = dim.select(F.col("id").alias("prev_id"), tax.bio_type(F.col("label")).alias("pt"), tax.is_bio(F.col("label")).alias("pok"))
    b = dim.select(F.col("id").alias("next_id"), tax.bio_prefix(F.col("label")).alias("np"), tax.bio_type(F.col("label")).alias("nt"), tax.is_bio(F.col("label")).alias("nok"))
    allowed = F.col("pok") & F.col("nok") & ((F.col("np") != "I") | (F.col("pt") == F.col("nt")))
    # one row per pair of labels: a fixed 27 x 27
    return a.join(F.broadcast(b), F.lit(True)).select("prev_id", "next_id", F.when(allowed, 0.0).otherwise(FORBIDDEN).alias("score"))


def viterbi(emissions: np.ndarray, trans: np.ndarray, labels: tuple[str, ...] = tax.LABELS, force_o: np.ndarray | None = None) -> list[int]:
    """The best label path over (T, C) logits in single precision; ties go to the lowest id; no path begins with I."""
    em = np.array(emissions, np.float32)
    if not len(em):
        return []
    if force_o is not None and force_o.any():
        em[force_o] = FORBIDDEN
        em[force_o, labels.index("O")] = 0
    score = em[0] + np.array([FORBIDDEN if x.startswith("I-") else 0 for x in labels], np.float32)
    back = []
    for row in em[1:]:
        step = score[:, None] + trans
        best = step.argmax(axis=0)
        back.append(best)
        score = row + step[best, np.arange(len(labels))]
    path = [int(score.argmax())]
    for best in reversed(back):
        path.append(int(best[path[-1]]))
    return path[::-1]


def viterbi_column(logits: Column, labels: tuple[str, ...] = tax.LABELS, force_o: Column | None = None) -> Column:
    """Labels of a sequence held in one row: array<array<float>> to array<int>."""
    trans = transitions(labels)

    @F.pandas_udf("array<int>")
    def decode(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for logits, forced in batches:
            yield pd.Series([
                viterbi(np.array([np.asarray(r, np.float32) for r in x], np.float32).reshape(-1, len(labels)), trans, labels, None if f is None else np.asarray(f, bool)) if x is not None else []
                for x, f in zip(logits, forced)
            ])

    return decode(logits, force_o if force_o is not None else F.lit(None).cast("array<boolean>"))


def decode(tokens: DataFrame, keys: list[str], how: str = "bio_viterbi", order: str = "tok_idx", column: str = "logits") -> DataFrame:
    """``tokens`` with ``label_id``, ``label``, and ``prob``, the softmax share of that label.

    ``argmax`` looks at each token alone; ``bio_viterbi`` gathers the tokens of a text, which one text bounds.
    """
    if how == "argmax":
        out = tokens.withColumn("label_id", argmax(F.col(column)))
    elif how == "bio_viterbi":
        rest = [c for c in tokens.columns if c not in keys]
        packed = tokens.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in rest if c != order]))).alias("_t"))
        path = viterbi_column(F.transform("_t", lambda t: t[column].cast("array<float>")))
        out = packed.withColumn("_z", F.explode(F.arrays_zip("_t", path.alias("path")))).select(*keys, *[F.col(f"_z._t.{c}").alias(c) for c in rest], F.col("_z.path").alias("label_id"))
    else:
        raise ValueError(f"decode is 'argmax' or 'bio_viterbi', not {how!r}")
    return out.withColumn("label", tax.id_to_label(F.col("label_id"))).withColumn("prob", F.get(softmax(F.col(column)), F.col("label_id")))
