"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ranks of a byte-level BPE vocabulary; every function below takes another path.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how byte-level BPE of this family cuts text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def _encoding(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counter(path: str = TOKENIZER) -> Callable[[Column], Column]:
    """A function of a text column: its number of tokens, 0 for an empty text, null for null."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        encode = _encoding(path).encode_ordinary
        return texts.map(lambda t: None if t is None else len(encode(t)) if t else 0).astype("Int64")

    return count
