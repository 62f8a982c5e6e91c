"""Positional joins without an exchange: tasks read the other side's rows where they lie."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, LongType, StructField, StructType

from nearfield.operators.ordinals import join_sized
from nearfield.sources.vecfiles import ROWS_PER_BATCH, Matrix, open_fs, open_matrix, read_rows


class _Files:
    """The vector file of one shard at a time."""

    def __init__(self, template: str):
        self.template, self.shard, self.file, self.matrix = template, None, None, None

    def open(self, shard: int | None) -> Matrix:
        if shard is None:
            raise ValueError("metadata rows without a shard number")
        if shard != self.shard:
            self.close()
            fs, path = open_fs(self.template % shard)
            self.shard, self.file = shard, fs.open_input_file(path)
            self.matrix = open_matrix("npy", path, self.file)
        return self.matrix

    def rows(self, shard: int, first: int, count: int) -> np.ndarray:
        self.open(shard)
        if first + count > self.matrix.total:
            raise ValueError(f"shard {shard}: no vector for metadata row {first + count - 1}, {self.matrix.total} vectors")
        return read_rows("npy", self.file, self.matrix, first, count).astype(np.float32)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _runs(shards: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where neighbouring rows are neighbours in their vector file too, in runs of a batch at most."""
    breaks = np.flatnonzero((np.diff(shards) != 0) | (np.diff(rows) != 1)) + 1
    edges = [0, *breaks.tolist(), len(rows)]
    for a, b in zip(edges, edges[1:]):
        for at in range(a, b, ROWS_PER_BATCH):
            yield at, min(at + ROWS_PER_BATCH, b)


def uneven_shards(meta: DataFrame, vectors: str, shard: str = "shard_no") -> DataFrame:
    """``(shard, n_meta, n_vectors)`` of metadata shards and the ``.npy`` files of their numbers, where they differ.

    Tasks read one header per shard.
    """
    counts = meta.groupBy(shard).agg(F.count(F.lit(1)).alias("n_meta"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(vectors)
        for batch in batches:
            totals = [files.open(n).total for n in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(totals, pa.int64())], names=[shard, "n_meta", "n_vectors"])
        files.close()

    shape = StructType([*counts.schema.fields, StructField("n_vectors", LongType())])
    return counts.mapInArrow(run, shape).where("n_meta != n_vectors")


def zip_in_place(
    meta: DataFrame, vectors: str, shard: str = "shard_no", row: str = "row_index", name: str = "vector", on_mismatch: str = "fail"
) -> DataFrame:
    """Add to row i of a metadata shard row i of the ``.npy`` file of the same number (``vectors``: path template).

    ``meta`` stays as it is read: a task opens the vector files of the metadata rows it holds and reads
    the matching ranges, so neither side is shuffled. Shards of unequal length raise, or are left out whole with
    ``on_mismatch='skip'``; both count the metadata in a job of their own. ``'ignore'`` does not count, so metadata
    may be filtered first, and only the vectors of what is left are read.
    """
    if on_mismatch not in ("fail", "skip", "ignore"):
        raise ValueError("on_mismatch must be 'fail', 'skip' or 'ignore'")
    if name in meta.columns:
        raise ValueError(f"metadata have a column {name}")
    if on_mismatch == "fail" and (first := uneven_shards(meta, vectors, shard).orderBy(shard).first()) is not None:
        raise ValueError(f"shard {first[shard]}: {first.n_meta} metadata rows, {first.n_vectors} vectors")
    if on_mismatch == "skip":
        uneven = uneven_shards(meta, vectors, shard).select(shard, F.lit(True).alias("_uneven"))
        meta = join_sized(meta, uneven, [shard], "left").where("_uneven IS NULL").drop("_uneven")
    kept = meta.columns
    shape = StructType([*meta.schema.fields, StructField(name, ArrayType(FloatType()))])
    shard_at, row_at = kept.index(shard), kept.index(row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(vectors)
        for batch in batches:
            shards, rows = (batch.column(i).to_numpy() for i in (shard_at, row_at))
            for a, b in _runs(shards, rows) if batch.num_rows else ():
                m = files.rows(int(shards[a]), int(rows[a]), b - a)
                edges = np.arange(0, m.size + 1, max(1, m.shape[1]), dtype=np.int32)[: b - a + 1]
                column = pa.ListArray.from_arrays(pa.array(edges), pa.array(m.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, column], names=[*kept, name])
        files.close()

    return meta.mapInArrow(run, shape)
