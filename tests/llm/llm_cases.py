"""Texts the tests of this folder share."""

import os
import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing", "ly"]) for _ in range(words))


#: Null and empty texts, white space, repeated rows, a null id, several texts under one id, long texts, copies in capitals.
EDGE = [
    (1, None), (2, ""), (3, "  \t\n "), (4, prose(1, 60)), (5, prose(1, 60).upper()), (6, prose(2, 3000)), (6, prose(2, 3000)),
    (None, prose(3, 40)), (None, None), (7, prose(4, 30)), (7, prose(5, 30)), (8, "one two"), (9, "ONE TWO"), (10, "é ß 日本語  x y  z"),
    (11, prose(1, 55) + " " + prose(9, 3)), (12, prose(2, 2990) + " end"), (13, "x" * 5000), (14, "a  b\n\nc \t d "), (15, prose(6, 50) + "\n" + prose(1, 30)),
]


SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
