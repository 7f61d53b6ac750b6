"""Sorted rows of a partition in pieces of whole groups."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def changes(b: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Whether a row differs from the one before in `names`; nulls are equal. The first row does not."""
    new = np.zeros(b.num_rows, bool)
    for c in names:
        col = b.column(c)
        if col.null_count:      # whole numbers stay whole numbers
            known = np.asarray(col.is_valid())
            new[1:] |= known[1:] != known[:-1]
            col = col.fill_null(col.drop_null()[0]) if known.any() else pa.array(np.zeros(len(col)))
        v = col.to_numpy(zero_copy_only=False)
        new[1:] |= v[1:] != v[:-1]
    return new


def whole_groups(batches: Iterator[pa.RecordBatch], names: Sequence[str], most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows sorted by `names` in pieces of whole groups, a group or about `most` rows at a time, with each row's group number."""
    rest: pa.RecordBatch | None = None

    for b in batches:
        if rest is not None and rest.num_rows:
            b = pa.Table.from_batches([rest, b]).combine_chunks().to_batches()[0]
        if not b.num_rows:
            continue
        group = np.cumsum(changes(b, names))
        last, start = int(np.searchsorted(group, group[-1])), 0
        while start < last:
            end = min(int(np.searchsorted(group, group[min(start + most, last - 1)], "right")), last)
            yield b.slice(start, end - start), group[start:end] - group[start]
            start = end
        rest = b.slice(last)
    if rest is not None and rest.num_rows:
        yield rest, np.zeros(rest.num_rows, np.int64)
