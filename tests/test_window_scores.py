"""Pairs of unlike lengths that go through the grid together score as each does alone."""

import random

import pytest

from tests.test_python_functions import plain_window
from textloom.functions import fuzzy


def test_pairs_together_equal_plain_windows(monkeypatch):
    rng = random.Random(6)
    text = lambda: "".join(rng.choices("ab é", k=rng.randrange(12)))
    pairs = [(text(), text()) for _ in range(150)]
    pairs = [(a, b) for a, b in pairs if len(a) != len(b)]
    for places in (1, 40, 1 << 16):
        monkeypatch.setattr(fuzzy, "PLACES_AT_ONCE", places)
        assert fuzzy.best_windows(pairs) == pytest.approx([plain_window(a, b) for a, b in pairs])


def test_weighted_scores_do_not_depend_on_the_other_pairs():
    rng = random.Random(7)
    text = lambda: " ".join("".join(rng.choices("abC,", k=rng.randrange(5))) for _ in range(rng.randrange(9)))
    pairs = [(text(), text()) for _ in range(200)] + [("", "a"), ("!", "?")]
    assert fuzzy.weighted_scores(pairs) == [fuzzy.weighted(a, b) for a, b in pairs]
    assert fuzzy.best_windows([]) == fuzzy.weighted_scores([]) == []
