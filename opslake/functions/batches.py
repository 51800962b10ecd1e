"""Parts of an Arrow column of texts, so that a function's memory does not follow the size of the batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are made Python objects at once; a longer text is a part of its own.
PART_BYTES = 1 << 20


def parts(texts: pa.Array, most: int = PART_BYTES) -> Iterator[pa.Array]:
    """Neighbouring slices of about ``most`` bytes each, in order; together they are the whole column."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(ends // most)) + 1).tolist(), len(texts)]
    for start, end in zip(cuts, cuts[1:]):
        yield texts.slice(start, end - start)
