import re

import numpy as np
import pyarrow as pa
import pytest

from stratiform.llm import words
from stratiform.llm.components import components

TEXTS = ["Ab cD ab", None, "", " ", "x" * 300 + " y" + "z" * 10, "é b\tq\n\r\x0b\x0cw", "Ab cd", "a" * 70]


@pytest.mark.parametrize("window", [7, 50, 1 << 20])
def test_words_are_the_runs_without_white_space(monkeypatch, window):
    monkeypatch.setattr(words, "WINDOW", window)
    w = words.words_of(pa.array(TEXTS))
    got = [(int(r), w.data[a:b].tobytes().decode()) for r, a, b in zip(w.row, w.start, w.end)]
    assert got == [(i, m) for i, t in enumerate(TEXTS) for m in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert w.hash[0] == w.hash[2] and len(set(w.hash.tolist())) == len({m.lower() for _, m in got})
    assert len(set(words.words_of(pa.array(TEXTS), lower=False).hash.tolist())) == len({m for _, m in got})


def test_windows_stay_in_their_text():
    w = words.words_of(pa.array(["a b c", "b c", "a b c d"]))
    first, value = w.windows(2)
    assert first.tolist() == [0, 1, 3, 5, 6, 7]
    assert value[0] == value[3] and value[1] == value[2] == value[4] and value[5] not in value[:5]


def test_slices_cover_all_rows_in_order(monkeypatch):
    monkeypatch.setattr(words, "WINDOW", 100)
    batch = pa.record_batch({"text": pa.array(["x" * (k * 37 % 190) for k in range(50)] + [None])})
    parts = list(words.slices(iter([batch])))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch])) and len(parts) > 10


@pytest.mark.parametrize("order", ["up", "mixed"])
def test_components_of_chains_stars_and_rings(frame, order):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(5, k) for k in range(1000, 1100)]
    edges = chain + star + [(7, 7), (8, 9), (9, 8), (8, 9), (None, 3)] + [(200, 201), (201, 202), (202, 200)]
    if order == "mixed":
        names = dict(zip(range(100, 161), np.random.default_rng(1).permutation(range(100, 161)).tolist()))
        edges = [(names.get(a, a), names.get(b, b)) for a, b in edges]
    got = dict(map(tuple, components(frame(edges, "a long, b long")).collect()))
    expected = {k: 100 for k in range(100, 161)} | {k: 5 for k in range(1000, 1100)} | {5: 5, 7: 7, 8: 8, 9: 8} | {k: 200 for k in (200, 201, 202)}
    assert got == expected


def test_components_of_nothing(frame):
    assert components(frame([], "a long, b long")).count() == 0
