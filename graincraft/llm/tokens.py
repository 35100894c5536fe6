"""Tokens of a public tokenizer, loaded once per Python worker from a file named by parameter."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

from pyspark import SparkFiles
from pyspark.sql import DataFrame

#: Default vocabulary file; a parameter of every operator that counts tokens.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that byte-level vocabularies of this kind cut words with.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


_SHIPPED: set[tuple[str, str]] = set()


def ship(df: DataFrame, path: str = VOCABULARY) -> None:
    """Send the vocabulary file, which the driver can read, to the executors, once for each application."""
    context = df.sparkSession.sparkContext
    if (context.applicationId, path) not in _SHIPPED:
        _SHIPPED.add((context.applicationId, path))
        context.addFile(path)


@lru_cache(maxsize=2)
def encoder(path: str = VOCABULARY, pattern: str = PATTERN):
    """The encoder of a ``.tiktoken`` file of ranks, without special tokens; in a worker, that of the file that was shipped."""
    import tiktoken

    with open(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, path: str = VOCABULARY) -> list[int]:
    """Token ids of the whole text; lone surrogates count as the replacement character."""
    return encoder(path).encode_ordinary(text)
