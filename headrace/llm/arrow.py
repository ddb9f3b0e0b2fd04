"""Applying a function to the Arrow batches of a frame."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def map_batches(
    frame: DataFrame, schema: str | StructType, make: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]
) -> DataFrame:
    """Apply ``make`` to every batch that has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from make(batch)

    return frame.mapInArrow(run, schema)
