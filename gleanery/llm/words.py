"""Words of Arrow batches as numbers: lower-cased A-Z, split at ASCII white space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Rows and bytes of text handled at a time.
ROWS, TEXT_BYTES = 1024, 1 << 23


def slices(batch: pa.RecordBatch, column: str, text_bytes: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of bounded text size; a longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (held + size > text_bytes or i - start >= ROWS):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes):
        yield batch.slice(start)


def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the distinct words, each word's place among them, number of words of each text); a null has none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    empty = pc.equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if empty.any():
        rows = np.repeat(np.arange(len(lengths)), lengths)
        lengths = np.bincount(rows[~empty], minlength=len(lengths))
        flat = flat.filter(pa.array(~empty))
    coded = flat.dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).astype(object)
    hashes = pd.util.hash_array(distinct, categorize=False) if len(distinct) else np.empty(0, np.uint64)
    return hashes, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), lengths


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit permutation that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
