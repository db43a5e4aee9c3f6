"""Longest common substring of two strings (the pair kernel).

Dynamic programming over two rolling rows, O(len(a) * len(b)) time.  Among
several longest common substrings it returns the one found first when the
second string is scanned in the outer loop: the earliest end position in
``b``, then the earliest end in ``a``.  Empty input gives ``""``.

Each row of the table is one NumPy vector operation over the code points of
``a``, so the inner loop runs in compiled code.  Only used on pairs a Spark
plan has already chosen (one per id), through the Arrow-batched
``pandas_udf`` below; it is never run over all pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def longest_common_substring(a: str | None, b: str | None) -> str:
    a = a or ""
    b = b or ""
    if not a or not b:
        return ""
    ca, cb = _codes(a), _codes(b)
    prev = np.zeros(len(ca), dtype=np.int32)
    best_len, best_end = 0, 0  # best_end: exclusive end in ``a``
    for ch in cb:
        cur = np.where(ca == ch, np.concatenate(([0], prev[:-1])) + 1, 0).astype(np.int32)
        i = int(np.argmax(cur))  # first position of the row maximum
        if cur[i] > best_len:
            best_len, best_end = int(cur[i]), i + 1
        prev = cur
    return a[best_end - best_len : best_end]


@F.pandas_udf(T.StringType())
def lcs_udf(left: pd.Series, right: pd.Series) -> pd.Series:
    """Vectorised entry point: one Arrow batch of pairs per call."""
    return pd.Series([longest_common_substring(x, y) for x, y in zip(left, right)], dtype=object)
