"""Encoding of a text column with a public tokenizer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import encoder


def texts_of(column: pa.Array) -> list[str | None]:
    """Values as str; bytes that aren't UTF-8 become replacement characters."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [None if b is None else b.decode("utf-8", "replace") for b in column.cast(pa.binary()).to_pylist()]


def encode_texts(df: DataFrame, key: str, text: str, *, path: str | None = None, pattern: str | None = None, out: str = "ids") -> DataFrame:
    """(key, ids): the token ids of each text, without special tokens; an empty array for null and empty texts.

    One row for each row, repeated keys included; a narrow transformation. ``path`` is the vocabulary file on the
    executors (by default that of byte_bpe_50k), ``pattern`` the split of texts into pieces. Strings of special tokens in
    a text are ordinary text. Texts are encoded whole, whatever their length, in time linear in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for b in batches:
            ids = [e.encode(t) for t in texts_of(b.column(1))]
            offsets = np.zeros(len(ids) + 1, np.int64)
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            start = 0
            while start < len(ids) or start == 0:  # offsets of a list are 32 bits wide
                stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + (1 << 30), side="right")) - 1)
                stop = min(stop, len(ids))
                part = pa.ListArray.from_arrays(pa.array((offsets[start : stop + 1] - offsets[start]).astype(np.int32)), pa.array(flat[offsets[start] : offsets[stop]], type=pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, stop - start), part], names=[key, out])
                start = stop
                if start >= len(ids):
                    break

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, `{out}` array<int>")


def with_token_counts(df: DataFrame, key: str, text: str, keep: tuple[str, ...] = (), *, path: str | None = None, pattern: str | None = None, out: str = "n_tokens", count: Callable[[str | None], int] | None = None) -> DataFrame:
    """(key, keep..., n_tokens): the number of tokens of each text, 0 for null and empty ones. ``count`` replaces the tokenizer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = count or encoder(path, pattern).count
        for b in batches:
            n = pa.array([counted(t) for t in texts_of(b.column(b.num_columns - 1))], type=pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n], names=[key, *keep, out])

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in (key, *keep))
    return df.select(key, *keep, text).mapInArrow(run, f"{fields}, `{out}` bigint")
