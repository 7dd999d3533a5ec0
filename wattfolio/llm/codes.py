"""Texts as arrays of code points, for work on many texts at once."""

from __future__ import annotations

import sys
from functools import cache

import numpy as np


@cache
def letters() -> np.ndarray:
    """True for the code points that are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


@cache
def spaces() -> np.ndarray:
    return np.fromiter((chr(i).isspace() for i in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, a blank after each, and where each text starts."""
    lower = [(t or "").lower() for t in texts]
    starts = np.cumsum([0, *(len(t) + 1 for t in lower)])[:-1]
    return np.frombuffer((" ".join(lower) + " ").encode("utf-32-le", "replace"), dtype=np.uint32), starts
