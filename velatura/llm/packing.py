"""Packing documents into sequences by best-fit decreasing.

A document's ids are those of its whole text and an end id. What fills windows of ``window`` tokens
is cut off as full windows; the rest, shorter than a window, is a piece. Pieces are placed longest
first, each in the open window with the least room that still takes it, found in a segment tree
over remaining capacities. A sequence is padded to ``window`` unless its length is a power of two, so windows
left with more than ``slack`` tokens of padding (the last few of a lot) are cut into sequences of powers of two
and need none.

Scale. Packing needs no exchange of tokens: each task packs what it reads, in lots of at most ``lot`` tokens
of pieces, so memory is bounded whatever the partition holds, and a lot wastes at most ``slack`` tokens for
each of its windows. Sequence ids are (partition, number in it), the same whenever a task runs again.

Tokens. Most texts consist of characters whose normalisation is known (ASCII without odd controls and the
precomposed Latin-1 letters); what stands between white space is looked up in a table of what was met before, its words in
another, and only new words are encoded. Any other text goes through the tokenizer as a whole; both ways give the same ids.

Defined cases: null and empty texts are one piece holding the end id; rows that repeat a doc_id are documents of their own;
an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, lean

END = 2
WINDOW = 4096
LOT = 4_000_000  # tokens of pieces packed together: 16 MB of ids
SLACK = 32
TABLE = 1_200_000  # runs of characters whose ids a worker keeps, about 300 bytes each with their words
WORDS_SHARE = 2  # for so many runs one word is kept by itself
SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

_KNOWN = re.compile("[\\t-\\r\\x20-\\x7eÀ-ÖØ-öø-ÿ]*+")
# of known characters: contractions, runs of letters, digits one by one, runs of the others but white space
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)} | {32: " "}


class WordTable:
    """ids of texts under a tokenizer of words with end marks, words being kept once encoded.

    New words go through the tokenizer's own merges, without its normalisation and splitting, which they have behind them.
    """

    def __init__(self, path: str, size: int = TABLE) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = size
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        parts = json.loads(self.tokenizer.to_str())
        self.merges = Tokenizer.from_str(json.dumps(parts | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "added_tokens": []}))
        if hasattr(self.merges.model, "_resize_cache"):
            self.merges.model._resize_cache(0)  # words come here once
        self.letters = _byte_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
        self.special = tuple(t for t in self.tokenizer.get_vocab(with_added_tokens=True) if t not in vocabulary)
        # the short way holds only for this kind of tokenizer
        trial = ("It's 10 o'clock, d'été-Übung!!  A_B\tc", "x", "")
        self.by_word = True
        self.by_word = self.ids(list(trial)) == [self._whole(x) for x in trial]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        """Put new words into the table."""
        ids = np.array(self.merges.encode_batch_fast([" ".join(new).encode().decode("latin-1").translate(self.letters)], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        if len(ends) == len(new):
            raw = ids.tobytes()
            self.words.update(zip(new, map(raw.__getitem__, map(slice, [0, *ends], ends))))
        else:
            self.words.update((w, self._whole(w)) for w in new)

    def _learn_runs(self, new: list[str]) -> None:
        """Put new runs of anything but white space into the table: their words' ids in a row."""
        if len(self.words) > self.size // WORDS_SHARE:
            self.words.clear()
        words = list(map(_WORDS.findall, new))
        if unseen := set().union(*words).difference(self.words):
            self._learn(list(unseen))
        get = self.words.__getitem__
        self.runs.update(zip(new, [get(w[0]) if len(w) == 1 else b"".join(map(get, w)) for w in words]))

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        short = [self.by_word and _KNOWN.fullmatch(t) is not None and not any(s in t for s in self.special) for t in texts]
        runs = [t.lower().split() if ok else () for t, ok in zip(texts, short)]
        met = set().union(*runs)
        if len(self.runs) > self.size:
            self.runs.clear()
        if new := met.difference(self.runs):
            self._learn_runs(list(new))
        get = self.runs.__getitem__
        return [b"".join(map(get, r)) if ok else self._whole(t) for t, ok, r in zip(texts, short, runs)]


@functools.cache
def word_table(path: str, size: int) -> WordTable:
    """One table per worker process, which the tasks that it runs share; it is emptied whenever it holds ``size`` runs."""
    return WordTable(path, size)


class OpenWindows:
    """Open windows by remaining capacity; a segment tree finds the least capacity that is enough."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.tree = [0] * (2 * self.leaves)  # number of open windows below each node
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, window: int) -> None:
        self.at[capacity].append(window)
        k = capacity + self.leaves
        while k:
            self.tree[k] += 1
            k >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(window, its capacity) of the tightest open window with room for ``need``, no longer open; None if there is none."""
        tree, k = self.tree, need + self.leaves
        if not tree[k]:
            while k > 1 and (k & 1 or not tree[k + 1]):  # up until something lies to the right
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.leaves:
                k = 2 * k if tree[2 * k] else 2 * k + 1
        capacity = k - self.leaves
        while k:
            tree[k] -= 1
            k >>= 1
        return self.at[capacity].pop(), capacity


def best_fit(lengths: list[int], window: int) -> list[list[int]]:
    """Windows as lists of piece numbers, by best-fit decreasing; ties go by piece number."""
    windows: list[list[int]] = []
    open_ = OpenWindows(window)
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = open_.take(lengths[piece])
        if found is None:
            w, room = len(windows), window
            windows.append([])
        else:
            w, room = found
        windows[w].append(piece)
        if room > lengths[piece]:
            open_.add(room - lengths[piece], w)
    return windows


def cut(lengths: list[int], pieces: list[int], window: int, slack: int) -> Iterator[list[tuple[int, int, int]]]:
    """The sequences of one window, each a list of (piece, begin, end)."""
    total = sum(lengths[p] for p in pieces)
    if window - total <= slack or total & (total - 1) == 0:
        yield [(p, 0, lengths[p]) for p in pieces]
        return
    bits = [1 << k for k in reversed(range(total.bit_length())) if total >> k & 1]
    queue = [(p, 0, lengths[p]) for p in reversed(pieces)]
    for room in bits:
        sequence = []
        while room:
            p, a, b = queue.pop()
            take = min(room, b - a)
            sequence.append((p, a, a + take))
            room -= take
            if a + take < b:
                queue.append((p, a + take, b))
        yield sequence


def _encoded(b: pd.DataFrame, table: WordTable, tail: bytes, most: int = 1 << 19) -> Iterator[tuple]:
    """(doc_id, ids with the end id) of each row; about ``most`` characters are encoded at a time."""
    docs, texts = b["doc_id"].tolist(), [t or "" for t in b["text"].tolist()]
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most or i == len(texts) - 1:
            yield from zip(docs[first : i + 1], [x + tail for x in table.ids(texts[first : i + 1])])
            first, size = i + 1, 0


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = END, window: int = WINDOW, lot: int = LOT, slack: int = SLACK, table: int = TABLE, keep_table: bool = True
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file, the same on every executor; a worker keeps ``table`` runs of characters (about 300 bytes each),
    for the tasks that follow if ``keep_table``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = word_table(tokenizer, table)
        tail = np.array([end], "<u4").tobytes()
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        rows: list[tuple] = []
        held: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        tokens = 0

        def close() -> None:
            nonlocal number, held, tokens
            lengths = [len(x[2]) // 4 for x in held]
            for pieces in best_fit(lengths, window):
                for sequence in cut(lengths, pieces, window, slack):
                    offset = 0
                    for p, a, b in sequence:
                        doc, start, ids, n = held[p]
                        rows.append((doc, start + a, b - a, zlib.crc32(ids[4 * a : 4 * b]), n, number, offset))
                        offset += b - a
                    number += 1
            held, tokens = [], 0

        def out() -> pd.DataFrame:
            nonlocal rows
            frame = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            rows = []
            return frame

        for b in batches:
            for doc, ids in _encoded(b, known, tail):
                n = len(ids) // 4
                full = n // window
                for k in range(full):
                    part = ids[4 * window * k : 4 * window * (k + 1)]
                    rows.append((doc, window * k, window, zlib.crc32(part), n, number, 0))
                    number += 1
                if n > full * window:
                    held.append((doc, full * window, ids[4 * window * full :], n))
                    tokens += n - full * window
                if tokens >= lot:
                    close()
                if len(rows) >= 50_000:
                    yield out()
        close()
        yield out()
        if not keep_table:
            del known
            word_table.cache_clear()

    kind = docs.schema[id_col].dataType.simpleString()
    return in_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).mapInPandas(lean(run), f"doc_id {kind}, {SCHEMA}")
