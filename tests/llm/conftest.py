import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hushline.llm.shipping import ship  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def prose():
    """A text of n words from few syllables, by seed."""
    def make(seed, n, vocabulary=400):
        draw = random.Random(seed)
        return " ".join(f"w{draw.randrange(vocabulary)}x{draw.randrange(3)}" for _ in range(n))

    return make
