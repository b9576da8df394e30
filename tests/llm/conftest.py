import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helpers import make_docs  # noqa: E402


@pytest.fixture(scope="session")
def odd_rows():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def text(n):
        out = [rng.choice(vocab) for _ in range(n)]
        return " ".join(w + ("\n" if i % 11 == 10 else "") for i, w in enumerate(out))

    base = text(120)
    near = base.split(" ")
    near[60] = "changed"
    long = text(6000)
    return [
        (1, base, "a"), (2, base, "a"), (3, " ".join(near), "b"), (4, base.upper(), "b"), (5, None, "a"), (6, "", None),
        (7, "  \n\t ", "a"), (8, "one", "c"), (9, "one two", "c"), (9, "one two", "c"), (10, "one  two", "c"),
        (None, base, None), (None, None, None), (11, long, "d"), (12, long + " tail", "d"), (13, "one two three", "c"),
        (14, text(40) + "\n" + base[:300], "a"), (14, text(30), "a"), (15, "é ü ñ ß “quoted” x³", "e"),
        (16, "idiot scum " + text(20), "a"), (17, "a\x00b " + text(15), "b"),
    ] + [(100 + i, text(rng.randint(1, 60)), rng.choice("abcd")) for i in range(40)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return make_docs(spark, odd_rows).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, []).cache()


@pytest.fixture(scope="session")
def tokenizer():
    from tidepool.llm.queries import default_tokenizer
    return default_tokenizer()
