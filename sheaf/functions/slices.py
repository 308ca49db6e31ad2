"""Arrow batches cut into slices, so that what a Python worker builds from a batch stays bounded."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_ROWS = 256         # rows of a slice at most
SLICE_BYTES = 2_000_000  # text of a slice, unless one row is longer


def slices(*texts: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
    """Equally long text columns a few rows at a time, in order."""
    n = len(texts[0])
    size = np.zeros(n, np.int64)
    for column in texts:
        size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    total, at = np.cumsum(size), 0
    while at < n:
        before = total[at] - size[at]
        end = min(at + SLICE_ROWS, max(at + 1, int(np.searchsorted(total, before + SLICE_BYTES, side="right"))))
        end = min(end, n)
        yield tuple(column.slice(at, end - at) for column in texts)
        at = end
