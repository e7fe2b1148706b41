"""Text encoders: anything that turns a list of texts into an array of vectors can stand in for ``hashed_ngrams``."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, functions as F, types as T

Encoder = Callable[[list[str]], np.ndarray]


def hashed_ngrams(texts: list[str], size: int = 256, n: int = 3) -> np.ndarray:
    """Counts of the runs of ``n`` characters of each word, marked at its ends, hashed with a sign into ``size`` places, at
    length 1; a zero vector for a text without words."""
    out = np.zeros((len(texts), size), np.float32)
    for row, text in zip(out, texts):
        for word in text.lower().split():
            padded = f"<{word}>"
            for i in range(max(1, len(padded) - n + 1)):
                h = xxhash.xxh3_64_intdigest(padded[i : i + n])
                row[h % size] += 1 if h >> 63 else -1
        norm = np.linalg.norm(row)
        if norm:
            row /= norm
    return out


def embedded(text: str | Column, encoder: Encoder = hashed_ngrams) -> Column:
    """The vector of each text as ``array<float>``; null for null. Whole batches are encoded at once."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def encode(texts: pa.Array) -> pa.Array:
        values = texts.to_pylist()
        vectors = iter(encoder([v for v in values if v is not None]))
        return pa.array([None if v is None else next(vectors).tolist() for v in values], pa.list_(pa.float32()))

    return encode(text)
