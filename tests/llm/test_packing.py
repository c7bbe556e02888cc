import random
import zlib

import numpy as np
import pytest

from velatura.llm import packing
from velatura.llm.queries import tokenizer_path

from .helpers import ODD, prose, table


def tokens(text):
    from tokenizers import Tokenizer

    t = tokens.__dict__.setdefault("t", Tokenizer.from_file(tokenizer_path()))
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


ODD_TEXTS = ["", "It's o'clock'll 'S", "İstanbul ΣΑΣ ﬁ", "a\x1cb\x85c d", "<|endoftext|> x <|startoftext|>", "ª º ² ½ ÷ × ß", "snake_case_9 __ 12345", "ÀÉ é ü", "é combining", "\x00 nul", "日本語 テスト", "'''s 't", prose(4, 400)]


@pytest.mark.parametrize("size", [600_000, 3])
def test_word_table_gives_the_tokenizers_ids(size):
    table_ = packing.WordTable(tokenizer_path(), size)
    assert table_.by_word
    for _ in range(2):
        assert [x + np.array([2], "<u4").tobytes() for x in table_.ids(ODD_TEXTS)] == [tokens(t).tobytes() for t in ODD_TEXTS]


def test_tightest_window():
    r = random.Random(1)
    lengths = [r.randrange(1, 100) for _ in range(500)]
    room: list[int] = []
    want: list[list[int]] = []
    for p in sorted(range(500), key=lambda i: (-lengths[i], i)):
        fit = [c for c in room if c >= lengths[p]]
        if fit:
            w = max(i for i, c in enumerate(room) if c == min(fit))
            room[w] -= lengths[p]
            want[w].append(p)
        else:
            room.append(99 - lengths[p])
            want.append([p])
    got = packing.best_fit(lengths, 99)
    assert sorted(sum(lengths[p] for p in w) for w in got) == sorted(sum(lengths[p] for p in w) for w in want)
    assert sorted(p for w in got for p in w) == list(range(500))


@pytest.mark.parametrize("lot", [4_000_000, 500])
def test_round_trip(spark, lot):
    rows = [(i if i is not None else 999, t, s) for i, t, s in ODD if i != 906] + [(i, prose(i, 1 + 37 * i % 1500), "a") for i in range(120)]
    out = packing.pack(table(spark, rows).repartition(3), tokenizer_path(), lot=lot).collect()
    pieces, sequences = {}, {}
    for r in out:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for i, t, _ in rows:
        ids, at = tokens(t), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    padding = total = 0
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 4096
        total += at
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding <= 0.01 * total


def test_repeated_rows_and_empty_table(spark):
    out = packing.pack(table(spark, [(1, "same", "a"), (1, "same", "a")]), tokenizer_path()).collect()
    assert len(out) == 2 or sum(r["length"] for r in out) == 2 * len(tokens("same"))
    assert packing.pack(table(spark, []), tokenizer_path()).count() == 0
