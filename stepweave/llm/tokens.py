"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where the vocabulary files lie; every function takes another path as parameter.
TOKENIZER_DIR = os.environ.get("STEPWEAVE_TOKENIZERS", "/opt/tokenizers")
DEFAULT_TOKENIZER = "byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank files.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def _counter(path: str):
    """Token count of one text; the vocabulary is loaded once per Python worker."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        own = tiktoken.Encoding("own", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda t: len(own.encode_ordinary(t))
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda t: len(pieces.encode(t, num_threads=1))
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return lambda t: len(tok.encode(t, add_special_tokens=False).ids)


def token_count(text: Column, tokenizer: str = DEFAULT_TOKENIZER, folder: str = TOKENIZER_DIR) -> Column:
    """Tokens of the whole text, 0 for NULL and empty texts."""
    path = os.path.join(folder, tokenizer)

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        size = _counter(path)
        return pd.Series([size(t) if t else 0 for t in texts], dtype="int64")

    return count(text)
