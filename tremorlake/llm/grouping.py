"""Groups in sorted Arrow batches, for mapInArrow after a repartition and a sort within partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal integer keys, of batches that are sorted by them; one run is held at a time."""
    held: list[pa.RecordBatch] = []

    def key(batch, i):
        return tuple(batch.column(c)[i].as_py() for c in keys)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(c).to_numpy() for c in keys]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        bounds = [0, *change.tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:], strict=False):
            part = batch.slice(a, b - a)
            if held and key(held[0], 0) != key(part, 0):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)
