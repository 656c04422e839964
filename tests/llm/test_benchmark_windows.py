"""Benchmark windows that reach the similarity although their SimHash is beyond the radius."""

import random
from collections import Counter

import pytest

from rivulet.llm.common import WordHashes
from rivulet.llm.decontaminate import Items


def plain_best(text, item):
    """The highest similarity of a window of the item's size, by brute force."""
    size = min(len(item), len(text))
    grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    own, best = grams(item), 0
    for start in range(len(text) - size + 1):
        mine = grams(text[start : start + size])
        common = (mine & own).total()
        best = max(best, common / (mine.total() + own.total() - common))
    return best


def test_a_window_beyond_the_radius_is_found():
    item = [f"s24w{i}" for i in range(59)]
    text = [f"s24x{i}" for i in range(6)] + item[6:]  # similarity 49 / 61, 16 bits apart
    found = Items([(7, " ".join(item).encode())], 15, 5).search([" ".join(text).encode()], WordHashes(), 0.8)
    assert found == [{0: (pytest.approx(49 / 61), 0, 59)}]


def test_hits_equal_brute_force_without_help_of_the_radius():
    rng = random.Random(3)
    for _ in range(60):
        item = [rng.choice("abcdefgh") + str(rng.randrange(6)) for _ in range(rng.randint(15, 60))]
        copy = list(item)
        for _ in range(rng.randint(0, 2)):
            copy[rng.choice([0, 1, 2, -1, -2, -3])] = "other"
        text = [f"q{i}" for i in range(rng.randint(0, 40))] + copy + [f"r{i}" for i in range(rng.randint(0, 40))]
        got = Items([(0, " ".join(item).encode())], 0, 5).search([" ".join(text).encode()], WordHashes(), 0.8)[0]
        want = plain_best(text, item)
        assert (got[0][0] if got else None) == (pytest.approx(want) if want >= 0.8 else None)
