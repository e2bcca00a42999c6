"""Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

#: Rows that a function takes as Python objects at once.
SLICE_ROWS = 1_000

_Batches = Iterator[pa.RecordBatch]


def in_slices(function: Callable[[_Batches], _Batches], rows: int = SLICE_ROWS) -> Callable[[_Batches], _Batches]:
    """``function`` over batches of at most ``rows`` rows, for ``mapInArrow``.

    Arrow's pool keeps what is freed, and an executor keeps its workers for later stages;
    so what is unused goes back after each batch and at the end.
    """

    def slices(batches: _Batches) -> _Batches:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield batch.slice(start, rows)
            batch = None
            pa.default_memory_pool().release_unused()

    @wraps(function)
    def run(batches: _Batches) -> _Batches:
        try:
            yield from function(slices(batches))
        finally:
            pa.default_memory_pool().release_unused()

    return run
