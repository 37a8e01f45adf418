"""Record batches cut by the bytes of their texts, so that what a library makes of one stays bounded."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts that are handled together: a tokenizer needs some 60 times their bytes.
BATCH_DOCS, BATCH_BYTES = 512, 1 << 19


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most BATCH_DOCS rows and, unless a row has more, BATCH_BYTES of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = sizes.cumsum()
    at = 0
    while at < len(sizes):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH_BYTES, side="right"))
        to = min(max(to, at + 1), at + BATCH_DOCS)
        yield batch.slice(at, to - at)
        at = to
