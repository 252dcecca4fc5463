import random

import numpy as np
import pyarrow as pa
import pytest

from wattledger.llm import words as W

from .conftest import alnum, lower, spaced, texts


@pytest.mark.parametrize("size", [1, 100, 1 << 20])
def test_words_of_each_text(size):
    for kind, rule, low in ((W.SPACED, spaced, False), (W.ALNUM, alnum, True)):
        for s in W.slices(pa.array(texts(), pa.string()), lower=low, size=size):
            w = W.words(s, kind)
            for i in range(s.rows):
                a, b = w.bounds[i], w.bounds[i + 1]
                got = [s.data[x:y].tobytes().decode() for x, y in zip(w.start[a:b], w.end[a:b])]
                assert got == rule(texts()[s.first + i])


def test_hash_tells_words_apart_and_only_words():
    draw = random.Random(1)
    given = list({"".join(draw.choice("ab") for _ in range(draw.randrange(1, 30))) for _ in range(20_000)})
    (s,) = W.slices(pa.array([" ".join(given * 2)]), size=1 << 30)
    w = W.words(s, W.SPACED)
    assert len(np.unique(w.hash)) == len(given)
    assert (w.hash[:len(given)] == w.hash[len(given):]).all()


def test_windows_stay_within_their_text():
    (s,) = W.slices(pa.array(["a b c", "", "a b c", "d"]))
    at, key = W.windows(W.words(s, W.SPACED), 2)
    assert at.tolist() == [0, 1, 3, 4]
    assert key[0] == key[2] and key[1] == key[3] and key[0] != key[1]


def test_lower_changes_ascii_only():
    (s,) = W.slices(pa.array(["AÉz"]), lower=True)
    assert s.data.tobytes().decode() == lower("AÉz") == "aÉz"
