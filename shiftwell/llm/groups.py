"""Groups of rows in tasks that read sorted batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def groups(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.RecordBatch]:
    """The rows of one value of ``by`` at a time, from batches sorted by that column."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch[by].to_numpy()
        if not len(values):
            continue
        cuts = np.nonzero(np.diff(values))[0] + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]):
            if held and held[-1][by][0].as_py() != values[start]:
                yield joined(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield joined(held)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches cut to a few rows, so that few become Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
