"""Small encoders behind the callable interface that real models use.

An encoder takes a list of texts and returns one vector (or None) per text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from vecloom.functions import kernels


def word_units(text: str) -> int:
    """Words between white space, as the units of a model that counts words."""
    return sum(1 for w in kernels.SPACE.split(text) if w)


class CountingEncoder:
    """Signed word counts per hash bucket, not normalized."""

    def __init__(self, dims: int):
        self.dims = dims

    def __call__(self, texts: list[str]) -> np.ndarray:
        return kernels.hash_counts(pa.array([t.lower() for t in texts], pa.string()), self.dims)


class HashingEncoder(CountingEncoder):
    """The counts as unit vectors."""

    def __call__(self, texts: list[str]) -> np.ndarray:
        return kernels.unit_rows(super().__call__(texts))


class ShortTextEncoder(HashingEncoder):
    """Refuses long texts, as a model with a fixed context does."""

    def __init__(self, dims: int, longest: int):
        super().__init__(dims)
        self.longest = longest

    def __call__(self, texts: list[str]) -> np.ndarray:
        if any(len(t) > self.longest for t in texts):
            raise ValueError("text too long")
        return super().__call__(texts)
