"""Token counts by a public tokenizer whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.runtime import bound_batches

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public split pattern that belongs to byte-level vocabularies of this family.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str = BYTE_PATTERN):
    import tiktoken

    lines = Path(path).read_bytes().splitlines()
    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line)}
    return tiktoken.Encoding(Path(path).name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, key: str, text: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(key, n_tokens) for every row; a null text has 0 tokens. Each worker loads the vocabulary once."""
    bound_batches(df.sparkSession)

    def count(batches):
        encode = encoding(vocabulary).encode_ordinary
        for batch in batches:
            sizes = [0 if t is None else len(encode(t)) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64())], ["key", "n_tokens"])

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(count, f"key {df.schema[key].dataType.simpleString()}, n_tokens bigint")
