from __future__ import annotations

import random

import pytest


@pytest.fixture(scope="session")
def rng():
    return random.Random(11)


@pytest.fixture(scope="session")
def prose(rng):
    """Texts of invented words."""
    parts = "the of and to er in on re th an ed st en at ou it he ha is ti".split()

    def text(words: int) -> str:
        return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(words))

    return text
