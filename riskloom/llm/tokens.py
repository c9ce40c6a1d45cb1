"""Token ids by a public byte-level BPE vocabulary (a tiktoken rank file whose path is a parameter).

The driver reads the file and broadcasts it: about 50,000 tokens, a fixed size that ``MOST_TOKENS`` checks.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import SparkSession

#: The public byte-level BPE splitting pattern that goes with the vocabulary files (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
MOST_TOKENS = 1 << 20


def vocabulary(spark: SparkSession, path: str = VOCABULARY) -> Broadcast:
    """Token bytes by id, on all executors."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    if len(pairs) > MOST_TOKENS:
        raise ValueError(f"vocabulary: more than {MOST_TOKENS} tokens")
    out = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return spark.sparkContext.broadcast(out)


def encoder(tokens: list[bytes]):
    """``encode(text) -> list of ids``; one per task."""
    import tiktoken
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)},
                             special_tokens={}).encode_ordinary


def encode_column(encode, column: pa.Array, dtype) -> list[np.ndarray]:
    """Ids of each text; none for null."""
    return [np.array(encode(text) if text else (), dtype) for text in column.to_pylist()]


def decode(tokens: list[bytes], ids) -> str:
    return b"".join(tokens[int(i)] for i in ids).decode("utf-8")
