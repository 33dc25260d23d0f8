"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published splitting pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_loaded: dict[str, object] = {}


def encoder(path: str = VOCABULARY):
    """The tokenizer of this vocabulary file; each worker loads it once."""
    if path not in _loaded:
        import tiktoken

        with open(os.path.realpath(path), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _loaded[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def with_token_counts(df: DataFrame, text: str, keep: list[str], path: str = VOCABULARY, name: str = "n_tokens") -> DataFrame:
    """``keep`` and the number of tokens of the whole text; null and empty text have 0. Texts don't come back from the workers."""
    keep_schema = [df.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(n, pa.int64())], names=[*keep, name])

    return df.select(*keep, text).mapInArrow(run, T.StructType([*keep_schema, T.StructField(name, T.LongType())]))
