"""Tokens and overlapping windows.

The tokenizer is a seam: anything that gives, for each text, the ends of its tokens in code points. The
default one takes runs of letters, runs of digits and single other characters, with two special tokens around
a sequence. Windows lie on a fixed grid, so each is worked out on its own, JVM-side, from per-token arrays.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.batches import in_batches
from ..functions.text import SENTENCE_END, TOKEN

SPECIALS = 2
TOKENS = "starts array<int>, ends array<int>, flags array<int>, origin array<int>"
#: Bits of a token's flag: its end is a word boundary; its last character ends a sentence.
BOUNDARY, SENTENCE = 1, 2

#: Tokens of a batch of arrays at most, or one text if that has more.
BATCH_TOKENS = 1 << 17

_TOKEN = regex.compile(TOKEN)
_WORDS = {"'", "’", "-", "_"}


def _last_characters(text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the characters before ``ends`` whether they belong to words, and whether they end sentences; each kind is looked at once."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")[ends - 1]
    kinds, at = np.unique(codes, return_inverse=True)
    chars = [chr(k) for k in kinds]
    return np.array([c.isalnum() or c in _WORDS for c in chars], bool)[at], np.array([c in SENTENCE_END for c in chars], bool)[at]


def offsets(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of a text's tokens."""
    starts, ends = array("i"), array("i")  # four bytes a token, however long the text
    for m in _TOKEN.finditer(text or ""):
        a, b = m.span()
        starts.append(a)
        ends.append(b)
    return np.asarray(starts), np.asarray(ends)


def _token_arrays(text: str | None) -> tuple[np.ndarray, ...]:
    """Starts, ends, flags, and the token where the word run that ends at each token's start begins."""
    s, e = offsets(text)
    if not len(s):
        return s, e, s, s
    w, z = _last_characters(text, e)
    glued = np.r_[False, s[1:] == e[:-1]]  # to the token before
    split = np.r_[glued[1:] & w[1:] & w[:-1], False]  # the end lies inside a word run
    at = np.arange(len(s))
    run = np.maximum.accumulate(np.where(glued & np.r_[False, w[:-1]], 0, at))  # first token of what lies glued to the left, all words
    return s, e, ~split * BOUNDARY + z * SENTENCE, run


def _arrays(text: str | None) -> tuple[list[int], ...]:
    return tuple(x.tolist() for x in _token_arrays(text))


def in_lists(rows: Iterable[tuple[np.ndarray, ...]], names: list[str]) -> Iterator[pa.Array]:
    """Structs of lists from the arrays of texts, in batches of about ``BATCH_TOKENS`` tokens, so that a worker holds no more than that of them."""
    held, size = [], 0

    def batch() -> pa.Array:
        at = pa.array(np.cumsum([0, *(len(r[0]) for r in held)]), pa.int32())
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(at, pa.array(np.concatenate(x), pa.int32())) for x in zip(*held)], names)

    for r in rows:
        held.append(r)
        size += len(r[0])
        if size >= BATCH_TOKENS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def tokenize(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the arrays ``starts``, ``ends``, ``flags``, ``origin`` of its texts' tokens; null texts have none."""

    @F.arrow_udf(f"struct<{', '.join(x.strip().replace(' ', ':', 1) for x in TOKENS.split(','))}>")
    def arrays(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from in_lists((_token_arrays(x.as_py()) for t in texts for x in t), ["starts", "ends", "flags", "origin"])

    return in_batches(df).withColumn("_tok", arrays(F.col(text_col))).select(*df.columns, "_tok.*")


def token_rows(tokenized: DataFrame, *keys: str) -> DataFrame:
    """(…keys, tok_idx, start, end), one row per token."""
    pairs = F.posexplode(F.arrays_zip(F.col("starts"), F.col("ends"))).alias("tok_idx", "_t")
    return tokenized.select(*keys, pairs).select(*keys, "tok_idx", F.col("_t.starts").alias("start"), F.col("_t.ends").alias("end"))


def check_window(max_length: int, stride: int, specials: int = SPECIALS, least: int = 9) -> tuple[int, int]:
    """(token budget, step) of windows of ``max_length`` tokens, specials included."""
    budget = max_length - specials
    if max_length < least or budget <= 0:
        raise ValueError(f"max_length too small: {max_length}")
    if not 0 <= stride < budget:
        raise ValueError(f"stride must lie in [0, {budget}): {stride}")
    return budget, budget - stride


def _flag(i: Column, bit: int) -> Column:
    """The flag bit of token ``i`` (from 0)."""
    return F.get("flags", i).bitwiseAND(F.lit(bit)) != 0


def _with(w: Column, *names: str, **new: Column) -> Column:
    return F.struct(*[w[n].alias(n) for n in names], *[v.cast("int").alias(k) for k, v in new.items()])


def grid(n: Column, budget: int, stride: int) -> Column:
    """Windows as structs: ``k``, ``start_tok``, ``limit`` (its end at most), ``hard_min`` (its end at least).

    Texts that fit one window have one, over the whole of them; so have texts without tokens.
    """
    step = budget - stride
    ks = F.when(n <= budget, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.floor((n - 1) / F.lit(step)).cast("int")))
    windows = F.transform(ks, lambda k: F.struct(k.alias("k"), (k * step).alias("start_tok"), F.least(k * step + budget, n).alias("limit")))
    return F.transform(windows, lambda w: _with(w, "k", "start_tok", "limit", hard_min=F.greatest(w["start_tok"] + 1, F.least(w["limit"], w["start_tok"] + step))))


def picked(windows: Column, n: Column, budget: int, stride: int, backoff: int) -> Column:
    """Windows with ``picked``, the end chosen for each.

    Ends at word boundaries up to ``backoff`` tokens before the limit compete, with 30 points for the end of a sentence and
    10 for others, less one for each token given up; under 0 points none counts, the nearest wins a tie.
    A window that no other follows takes all there is.
    """

    def pick(w: Column) -> Column:
        def points(d: Column) -> Column:
            end = w["limit"] - d - 1
            value = F.when(_flag(end, BOUNDARY), F.when(_flag(end, SENTENCE), 30).otherwise(10) - d).otherwise(-1)
            return F.struct(value.alias("points"), (-d).alias("less"))

        last = (w["start_tok"] + (budget - stride) >= n) | (w["limit"] <= w["hard_min"]) | F.lit(backoff <= 0)
        back = F.least(F.lit(max(backoff, 0)), w["limit"] - w["hard_min"] - 1)
        best = F.array_max(F.transform(F.sequence(F.lit(0), F.greatest(back, F.lit(0))), points))
        return F.when(last | (best["points"] < 0), w["limit"]).otherwise(w["limit"] + best["less"])

    return F.transform(windows, lambda w: _with(w, "k", "start_tok", "limit", "hard_min", picked=pick(w)))


def windows(tokenized: DataFrame, max_length: int = 512, stride: int = 64, backoff: int = 32) -> DataFrame:
    """``tokenized`` with ``windows``: structs of ``k``, ``start_tok``, ``limit``, ``hard_min``, ``picked``, ``from_tok``, ``end_tok``.

    After the end is picked it goes back while it cuts a word, then while the window, begun at the word its start
    cuts (``from_tok``), holds more than ``max_length`` tokens, never past ``hard_min``. Windows after the first that
    reaches the last token are dropped. A text's windows are made within its row, so nothing is shuffled.
    """
    budget, _ = check_window(max_length, stride)
    n = F.size("starts")
    few = ("k", "start_tok", "limit", "hard_min", "picked")

    def ended(w: Column) -> Column:
        back = F.filter(F.sequence(w["hard_min"], F.greatest(w["picked"], w["hard_min"])), lambda e: (e == w["hard_min"]) | _flag(e - 1, BOUNDARY))
        end = F.when(w["picked"] <= w["hard_min"], w["picked"]).otherwise(F.array_max(back))
        return _with(w, *few, from_tok=F.coalesce(F.get("origin", w["start_tok"]), F.lit(0)), cut=end)

    def fitted(w: Column) -> Column:
        end = F.when(w["cut"] - w["from_tok"] <= budget, w["cut"]).otherwise(F.greatest(w["hard_min"], w["from_tok"] + budget))
        return _with(w, *few, from_tok=F.when(n <= budget, 0).otherwise(w["from_tok"]), end_tok=F.when(n <= budget, n).otherwise(end))

    column = F.transform(F.transform(picked(grid(n, budget, stride), n, budget, stride, backoff), ended), fitted)
    made = tokenized.withColumn("windows", column)
    reach = F.array_min(F.transform(F.filter("windows", lambda w: w["end_tok"] >= n), lambda w: w["k"]))
    return made.withColumn("_reach", reach).withColumn("windows", F.filter("windows", lambda w: F.col("_reach").isNull() | (w["k"] <= F.col("_reach")))).drop("_reach")


def chunks(tokenized: DataFrame, *keys: str, max_length: int = 512, stride: int = 64, backoff: int = 32, text_col: str = "text") -> DataFrame:
    """(…keys, chunk_index, start_tok, end_tok, char_start, char_end, n_retok, fits), one row per window.

    What separates a window's last token from the next belongs to the window; ``n_retok`` is what the window's text takes
    with the specials, and ``fits`` is false where that is more than ``max_length``.
    """
    made = windows(tokenized, max_length, stride, backoff)
    whole = (F.size("starts") <= max_length - SPECIALS) | (F.size("starts") == 0)

    def span(w: Column) -> Column:
        start = F.when(whole, 0).otherwise(F.coalesce(F.get("starts", w["from_tok"]), F.lit(0)))
        end = F.when(w["end_tok"] >= F.size("starts"), F.coalesce(F.length(F.col(text_col)), F.lit(0))).otherwise(F.get("starts", w["end_tok"]))
        return _with(w, "k", "start_tok", "end_tok", char_start=start, char_end=end, n_retok=w["end_tok"] - w["from_tok"] + SPECIALS)

    rows = made.select(*keys, F.inline(F.transform("windows", span)))
    return rows.withColumnRenamed("k", "chunk_index").withColumn("fits", F.col("n_retok") <= max_length)
