"""Sizes of texts in tokens of a public tokenizer, whose file is a parameter."""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, functions as F

#: Fixed value: the published pre-tokenization pattern of this family of byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: str | Column, tokenizer: str) -> Column:
    """Number of tokens of a text as BIGINT; null for null, 0 for an empty text. The file at ``tokenizer`` must be
    readable under that path on every executor."""

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        encoding = _encoding(tokenizer)
        return pa.array([None if t is None else len(encoding.encode_ordinary(t)) for t in texts.to_pylist()], pa.int64())

    return count(text)
