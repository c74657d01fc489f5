"""Arrow columns of texts as Python strings, a bounded part of a batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed value: bytes of text that are held as Python strings at once; a longer text makes a part of its own.
PART = 1 << 20


def parts(texts: pa.Array, most: int = PART) -> Iterator[list[str | None]]:
    """The rows of `texts` in order, in parts of at most `most` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield texts.slice(at, upto - at).to_pylist()
        at = upto


def mapped(texts: pa.Array, f: Callable[[list[str | None]], pa.Array], kind: pa.DataType, most: int = PART) -> pa.Array:
    """`f` of each part, as one array of type `kind`."""
    done = [f(part) for part in parts(texts, most)]
    return pa.concat_arrays(done) if done else pa.array([], kind)
