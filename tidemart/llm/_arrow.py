"""Arrow batches in bounded slices."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

SLICE_BYTES = 2 << 20


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` cut so that each part has about ``limit`` bytes, or one row."""
    rows = max(1, int(batch.num_rows * limit // max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def map_batches(
    df: DataFrame,
    work: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: str | StructType,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """``df.mapInArrow`` over slices of ``limit`` bytes; ``work()`` makes a task's own function."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = work()
        for batch in batches:
            for part in slices(batch, limit):
                yield step(part)
            # Workers stay for other tasks; what a batch took is not kept for them.
            batch = part = None
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
