"""Token counts by a public tokenizer, in Arrow batches.

The vocabulary file is a parameter (a tiktoken rank file); it is read once per
Python worker and never copied into the repository. Null and empty texts have
no tokens.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = os.environ.get("CLAUSEWORKS_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: Fixed value: the public pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ENCODERS: dict = {}
#: Longer texts are encoded in parts cut at line ends or blanks, so that one merge never spans a huge run.
PART = 20_000


def encoder(path: str = VOCABULARY):
    import tiktoken

    if path not in _ENCODERS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def count_tokens(text: str, path: str = VOCABULARY) -> int:
    """Tokens of the whole text; a run without white space longer than PART is cut for the merge."""
    encode = encoder(path).encode_ordinary
    total, at, n = 0, 0, len(text)
    while n - at > PART:
        cut = max(text.rfind("\n", at, at + PART), text.rfind(" ", at, at + PART))
        cut = cut if cut > at else at + PART
        total += len(encode(text[at:cut]))
        at = cut
    return total + len(encode(text[at:]))


def with_token_counts(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), path: str = VOCABULARY) -> DataFrame:
    """``keep`` columns and ``n_tokens`` (long) of column ``text``; one map, no shuffle."""
    narrow = df.select(*keep, text)
    fields = [f for f in narrow.schema.fields if f.name in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_tokens long"
    k = len(keep)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = pa.array([count_tokens(t, path) if t else 0 for t in batch.column(k).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], n], names=[*keep, "n_tokens"])

    return narrow.mapInArrow(count, schema)
