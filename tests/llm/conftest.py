import random

import pytest


@pytest.fixture(scope="module")
def rng():
    return random.Random(7)
