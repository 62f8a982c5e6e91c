"""All metrics of vector pairs in one pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from nearfield.operators.kernel import to_matrix


def pair_metrics(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Replace two vector columns by ``l2``, ``similarity``, ``cosine_distance`` and ``l2_normalized``.

    The same values as the column functions, in double precision and Arrow batches: a zero vector has
    similarity 0 and is its own normal form. NULL, ragged or non-finite vectors are errors.
    """
    keys = [c for c in pairs.columns if c not in (a, b)]
    names = ["l2", "similarity", "cosine_distance", "l2_normalized"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (to_matrix(batch.column(c)).astype(np.float64) for c in (a, b))
            if x.shape != y.shape:
                raise ValueError(f"vectors of dimension {x.shape[1]} and {y.shape[1]}")
            nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
            norms = nx * ny
            cosine = np.where(norms == 0, 0.0, (x * y).sum(axis=1) / np.where(norms == 0, 1, norms))
            ux, uy = (m / np.where(n == 0, 1, n)[:, None] for m, n in ((x, nx), (y, ny)))
            found = [((x - y) ** 2).sum(axis=1), cosine, np.maximum(0.0, 1 - cosine), ((ux - uy) ** 2).sum(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keys), *map(pa.array, found)], names=[*keys, *names]
            )

    kinds = [f"`{c}` {pairs.schema[c].dataType.simpleString()}" for c in keys] + [f"{n} double" for n in names]
    return pairs.select(*keys, a, b).mapInArrow(run, ", ".join(kinds))
