"""Exact search that skips whole blocks of vectors by the triangle inequality.

Vectors are stored in blocks of near ones, a Parquet row group each, with every block's centre and radius
in a small table. A block whose nearest possible point lies beyond a query's k-th distance is not read for it;
blocks no query asks for are not read at all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield import schemas
from nearfield.functions.metrics import get_metric
from nearfield.operators.kernel import to_matrix
from nearfield.operators.knn import BROADCAST_BYTES, PAIRS, TASK_BYTES, Search, _broadcast, _size, knn, kth_bounds
from nearfield.operators.ordinals import with_ordinal
from nearfield.operators.topk import top_k
from nearfield.session import cut_lineage
from nearfield.sources.vecfiles import PART_BYTES, open_fs

BLOCK_ROWS = 4096
ROWS_AT_ONCE = 1024  # rows whose distances to all pivots a task holds
QUERIES_AT_ONCE = 8192  # queries whose distances to a centre are computed together
ASKED = 2048  # longest list of queries beside a block; a block asked for by more has several rows
MOST_PIVOTS = 1024  # sampled vectors that shape the blocks; they go to the driver and to every writing task
BALL = "path string, row_group int, n_rows long, centre array<double>, radius double"
SLACK = 1e-9  # computed distances are off by far less


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances between rows of ``a`` and ``b`` in double precision, not below the true ones by more than rounding."""
    out = np.empty((len(a), len(b)))
    for i, row in enumerate(a):  # differences, not products: no cancellation
        out[i] = np.sqrt(np.einsum("ij,ij->i", b - row, b - row))
    return out


@dataclass(frozen=True)
class BallTable:
    """A folder of vector files in blocks and the table of their balls."""

    path: str
    n_rows: int
    dim: int

    def balls(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/balls")

    def scan(self, spark: SparkSession) -> DataFrame:
        """``id, vector`` of all blocks, for searches without pruning."""
        files = [r.path for r in self.balls(spark).select("path").distinct().collect()]  # one per PART_BYTES of vectors
        return spark.read.schema("id long, vector array<float>").parquet(*files)


class _BlockWriter:
    """One file of a task; a row group and a ball for every block."""

    def __init__(self, folder: str):
        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.parquet"
        self.path, self.number = f"{folder}/{name}", 0
        self.schema = pa.schema([("id", pa.int64()), ("vector", pa.list_(pa.float32()))])
        self.out = pq.ParquetWriter(f"{root}/{name}", self.schema, filesystem=fs)

    def write(self, ids: np.ndarray, m: np.ndarray) -> tuple:
        edges = pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1])
        table = pa.table([pa.array(ids), pa.ListArray.from_arrays(edges, pa.array(m.ravel()))], schema=self.schema)
        self.out.write_table(table, row_group_size=len(m))
        centre = m.mean(axis=0, dtype=np.float64)
        radius = float(distances(centre[None], m.astype(np.float64)).max()) * (1 + SLACK)
        self.number += 1
        return self.path, self.number - 1, len(m), centre.tolist(), radius

    def close(self) -> None:
        self.out.close()


def write_balls(
    df: DataFrame, dest: str, id_col: str = "pk", vector_col: str = "vector", block_rows: int = BLOCK_ROWS
) -> BallTable:
    """Store vectors in blocks of at most ``block_rows`` near ones below ``dest``, which must be new.

    Rows are put in order of their nearest and second nearest pivot and their distance; up to ``MOST_PIVOTS`` pivots are
    vectors drawn by a hash of their id. A cell with most of the rows is cut like any other, by its second pivots. Files
    count once the table that lists them is written, so lost tasks leave only unlisted ones.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("vector"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim")).first()
    number = min(MOST_PIVOTS, -(-size.n // block_rows) * 4)
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(number).select("vector").toArrow()["vector"]
    pivots = np.unique(to_matrix(drawn), axis=0).astype(np.float64) if number else np.zeros((0, 0))
    shared = spark.sparkContext.broadcast(pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = (shared.value**2).sum(axis=1)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                m = to_matrix(part.column(1)).astype(np.float64)
                away = squares - 2 * m @ shared.value.T  # only orders the rows, so it may be rough
                first = away.argmin(axis=1)
                at = np.arange(len(m))
                nearest = away[at, first]
                away[at, first] = np.inf
                columns = [pa.array(first), pa.array(away.argmin(axis=1)), pa.array(nearest)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=["id", "vector", "a", "b", "away"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, cell = None, [], None

        def block() -> tuple:
            ids, m = (np.concatenate(x) for x in zip(*held))
            held.clear()
            return out.write(ids, m)

        balls = []
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or _BlockWriter(f"{dest}/vectors")
            ids, m, cells = batch.column(0).to_numpy(), to_matrix(batch.column(1)), batch.column(2).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
            for a, b in zip(edges, edges[1:]):
                if held and cells[a] != cell:
                    balls.append(block())
                cell = cells[a]
                while a < b:
                    take = min(b, a + block_rows - sum(len(x[0]) for x in held))
                    held.append((ids[a:take], m[a:take]))
                    a = take
                    if sum(len(x[0]) for x in held) == block_rows:
                        balls.append(block())
        if out is None:
            return
        if held:
            balls.append(block())
        out.close()
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*balls), kinds)], names=["path", "row_group", "n_rows", "centre", "radius"]
        )

    parts = max(1, -(-size.n * 4 * (size.dim or 0) // PART_BYTES))
    placed = rows.mapInArrow(place, "id long, vector array<float>, a long, b long, away double")
    ordered = placed.repartitionByRange(parts, "a", "b", "away", "id").sortWithinPartitions("a", "b", "away", "id")
    balls = cut_lineage(ordered.select("id", "vector", "a").mapInArrow(write, BALL), "balls")
    with_ordinal(balls, ["path", "row_group"], "block").write.parquet(f"{dest}/balls")
    return BallTable(dest, size.n, size.dim or 0)


def needed_blocks(balls: DataFrame, queries: DataFrame, plan: Search) -> DataFrame:
    """``balls`` that can hold a row of some query's list, with those queries in ``qids``.

    A block has a row for every ``ASKED`` of its queries, one after the other. ``queries`` have a ``bound`` on the
    square of their k-th distance (null: none known).
    """
    shared = _broadcast(queries)

    def asking(centre: np.ndarray, radius: float, qids, vectors, reach) -> np.ndarray:
        found = []
        for lo in range(0, len(qids), QUERIES_AT_ONCE):
            own = slice(lo, lo + QUERIES_AT_ONCE)
            near = distances(centre[None], vectors[own])[0] - radius <= reach[own]
            found.append(qids[own][near])
        return np.concatenate(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, vectors, bounds = shared.value
        reach = np.sqrt(np.maximum(bounds, 0)) * (1 + SLACK) + SLACK
        centre_at, radius_at = names.index("centre"), names.index("radius")
        for batch in batches:
            for at in range(batch.num_rows):
                part = batch.slice(at, 1)
                centre, radius = part.column(centre_at).flatten().to_numpy(), part.column(radius_at)[0].as_py()
                asked = asking(centre, radius, qids, vectors, reach)
                for lo in range(0, len(asked), ASKED):
                    own = asked[lo : lo + ASKED]
                    lists = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), pa.array(own))
                    yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*names, "qids"])

    names = balls.columns
    kinds = ", ".join(f"{n} {t}" for n, t in balls.dtypes)
    return balls.mapInArrow(run, f"{kinds}, qids array<long>")


def _search(blocks: DataFrame, queries: DataFrame, plan: Search) -> DataFrame:
    """Candidates ``(qid, id, distance)`` of every block for the queries that ask for it."""
    shared = _broadcast(queries)
    at_once = plan.at_once()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, vectors, bounds = shared.value
        order = np.argsort(qids)
        opened, file, read, rows = None, None, None, None
        for batch in batches:
            asked, edges = batch.column(2).flatten().to_numpy(), np.cumsum([0, *batch.column(2).value_lengths().to_pylist()])
            for i, (path, group) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if path != opened:
                    fs, p = open_fs(path)
                    opened, file = path, pq.ParquetFile(fs.open_input_file(p))
                if (path, group) != read:
                    table = file.read_row_group(group)
                    read, rows = (path, group), (table["id"].combine_chunks().to_numpy(), to_matrix(table["vector"]))
                for lo in range(edges[i], edges[i + 1], at_once):
                    wanted = asked[lo : min(lo + at_once, edges[i + 1])]
                    own = order[np.searchsorted(qids, wanted, sorter=order)]
                    part = plan.block(qids[own], vectors[own], bounds[own])
                    part.add(*rows, False)
                    yield from part.results()

    return blocks.select("path", "row_group", "qids").mapInArrow(run, PAIRS)


def knn_balls(
    table: BallTable, queries: DataFrame, k: int, *, query_block: int = 512,
    broadcast_bytes: int = BROADCAST_BYTES, task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """:func:`knn` under squared L2 over stored blocks: the same answer, blocks that cannot matter left unread.

    The blocks around the nearest centres are searched first; their k-th distance bounds each query. A
    query set beyond ``broadcast_bytes`` or ``task_bytes`` is searched without pruning, by ``knn`` over the stored vectors.
    """
    spark, metric = queries.sparkSession, get_metric("l2")
    queries = queries.select(F.col("qid").cast("long").alias("qid"), "vector")
    size = _size(queries)
    plan = Search(k, metric, False, False, query_block, size.n, size.dim, None, broadcast_bytes, task_bytes)
    if size.n == 0 or not table.n_rows:
        return spark.createDataFrame([], schemas.NEIGHBORS)
    if not plan.fits_broadcast():
        return knn(table.scan(spark), queries, k, metric, id_col="id", broadcast_bytes=broadcast_bytes, task_bytes=task_bytes)
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(table.n_rows * 4 * table.dim / PART_BYTES))
    balls = table.balls(spark)
    n_balls = balls.count()
    probes = min(n_balls, 2 + math.ceil(2 * k * n_balls / table.n_rows))
    centres = balls.select(F.col("block").alias("pk"), F.col("centre").cast("array<float>").alias("vector"))
    near = knn(centres, queries, probes, metric).select("qid", F.col("id").alias("block"))
    near = near.groupBy("block").agg(F.collect_list("qid").alias("qids"))  # at most all queries, which fit a broadcast
    unbounded = queries.withColumn("bound", F.lit(None).cast("double"))
    first = balls.join(near, "block").repartition(tasks, "block")
    bounds = kth_bounds(top_k(_search(first, unbounded, plan), k, metric), k, metric)
    bounded = cut_lineage(queries.join(bounds, "qid", "left"), "bounds")
    needed = needed_blocks(balls.repartition(tasks, "block"), bounded, plan)
    return top_k(_search(needed, bounded, plan), k, metric)
