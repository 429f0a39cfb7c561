"""The table of known pieces a token-file task keeps stays below the size at which it doubles."""

import sys

from textloom.llm import tokenfile


def test_the_table_of_pieces_does_not_double():
    held = sys.getsizeof(dict.fromkeys(range(tokenfile.MOST_PIECES)))
    assert held <= 0.6 * sys.getsizeof(dict.fromkeys(range(1_500_000)))
