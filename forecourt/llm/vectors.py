"""Columns of vectors as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_width(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their matrix in double precision) for each length among the usable vectors.

    A vector is usable unless it is null or has a null or non-finite component.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    # A null component comes out as NaN.
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = column.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]])
    for width in np.unique(sizes[good]):
        rows = np.flatnonzero(good & (sizes == width))
        yield rows, values[offsets[rows][:, None] + np.arange(width)]
