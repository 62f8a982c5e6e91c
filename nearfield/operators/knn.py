"""Exact k nearest neighbours of every query in a base table."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.functions.metrics import Metric, get_metric
from nearfield.operators.kernel import QueryBlock, to_matrix
from nearfield.operators.topk import top_k
from nearfield.session import cut_lineage, scratch_path
from nearfield.sources.vecfiles import open_fs

UNIQUE_QIDS = "query ids must be unique and not NULL"
PAIRS = "qid long, id long, distance double"
TASK_BYTES = 3 << 29  # working memory one task may spend on queries and their lists
BROADCAST_BYTES = 128 << 20
CELL_ROWS = 1 << 18  # base rows per task of a pilot search
HELD_BYTES = 128 << 20  # base vectors a task keeps while query blocks stream past
STATE_BYTES = 64 << 20  # working memory of the queries compared with the held rows at once
FEWEST_AT_ONCE = 2_048  # queries compared at once, however long their lists
CELL_HELD = 8_192  # held rows are put together to about as many before they are compared
PILOT_FROM = 10_000_000  # base rows from which a pilot pass pays for itself
PILOT_FRACTION = 0.01
PILOT_FILES = 4  # fewest files a pilot is made of


def knn(
    base: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str | Metric,
    *,
    expr: str | None = None,
    normalize_base: bool = False,
    normalize_query: bool = False,
    query_block: int = 512,
    prune_fraction: float | None = None,
    query_blocks: int | None = None,
    per: str | None = None,
    bounds: DataFrame | None = None,
    id_col: str = "pk",
    vector_col: str = "vector",
    broadcast_bytes: int = BROADCAST_BYTES,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Neighbours (``qid``, ``rank``, ``id``, ``distance``) of ``queries(qid, vector)``.

    ``expr`` filters the base before the search, so it reaches the scan. A base smaller than k
    gives fewer rows, never padding. Ties go to the smaller id. ``per`` names a base column
    (a shard number) whose values get neighbour lists of their own.

    A query set that fits ``broadcast_bytes`` and ``task_bytes`` is broadcast and the base is
    read in place. A larger one, or any with ``query_blocks``, is written to the shared folder in
    blocks; the base stays in place all the same, and every task streams the blocks past the base
    rows it holds. Nothing but candidates is shuffled, and no vector reaches the driver.

    ``bounds`` (``qid``, ``bound``, see ``kth_bounds``) are known limits of each query's k-th distance;
    base rows beyond them may be left out of the result. ``prune_fraction`` first searches that share of the base. Each query's k-th distance there
    is an upper bound for the final one, so the main pass sends on about k / fraction rows per
    query instead of k per task. The answer is the same. ``None`` decides by the base's row
    count, 0 turns it off. The base is evaluated for the count, the pilot and the search, so
    hand in a stored table rather than a long computation.
    """
    metric = get_metric(metric)
    if k < 1:
        raise ValueError("k must be positive")
    if per is not None and prune_fraction:
        raise ValueError("per does not combine with prune_fraction")
    if expr is not None:
        base = base.where(F.expr(expr))
    base = base.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).alias("vector"),
        *([F.col(per).cast("long").alias(per)] if per else []),
    )
    queries = queries.select(F.col("qid").cast("long").alias("qid"), "vector")

    size = _size(queries)
    if size.n == 0:
        return queries.sparkSession.createDataFrame(
            [], (f"{per} long, " if per else "") + "qid long, rank int, id long, distance double"
        )
    plan = Search(
        k, metric, normalize_base, normalize_query, query_block, size.n, size.dim,
        query_blocks, broadcast_bytes, task_bytes,
    )
    if not plan.fits_broadcast():
        if queries.agg(F.count_distinct("qid")).first()[0] != size.n:
            raise ValueError(UNIQUE_QIDS)

    if per is not None:
        # A list per shard is as long as the shard allows, so there is no bound to prune with.
        return top_k(_per_shard(plan, base, queries, per), k, metric, per=per)

    if prune_fraction is None:
        prune_fraction = PILOT_FRACTION if base.count() >= PILOT_FROM else 0
    if bounds is None:
        bounded = queries.withColumn("bound", F.lit(None).cast("double"))
    else:
        bounded = queries.join(bounds.select("qid", "bound"), "qid", "left")
    if prune_fraction:
        bounded = _bounds_from_pilot(plan, base, bounded, prune_fraction)
    return plan.run(base, bounded)


def _size(queries: DataFrame):
    return queries.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("dim")
    ).first()


def candidate_pairs(
    base: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str | Metric,
    *,
    expr: str | None = None,
    normalize_base: bool = False,
    normalize_query: bool = False,
    query_block: int = 512,
    bounds: DataFrame | None = None,
    id_col: str = "pk",
    vector_col: str = "vector",
    broadcast_bytes: int = BROADCAST_BYTES,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """The part of :func:`knn` that reads the base: ``(qid, id, distance)``, at most ``k`` per task and query.

    The base is only mapped, so it may be a stream. Rows beyond ``bounds`` may be left out.
    """
    queries = queries.select(F.col("qid").cast("long").alias("qid"), "vector")
    size = _size(queries)
    plan = Search(
        k, get_metric(metric), normalize_base, normalize_query, query_block, size.n, size.dim, None, broadcast_bytes, task_bytes
    )
    base = base if expr is None else base.where(F.expr(expr))
    base = base.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    if bounds is not None:
        queries = queries.join(bounds.select("qid", "bound"), "qid", "left")
    return plan.pairs(base, queries)


@dataclass(frozen=True)
class Search:
    k: int
    metric: Metric
    normalize_base: bool
    normalize_query: bool
    query_block: int
    n_queries: int
    dim: int
    query_blocks: int | None
    broadcast_bytes: int
    task_bytes: int

    def state_bytes(self) -> int:
        """Raw and ranking copies of the queries, plus held and waiting list entries."""
        return self.n_queries * (16 * self.dim + 128 * self.k)

    def fits_broadcast(self) -> bool:
        return (
            self.query_blocks is None
            and self.n_queries * (4 * self.dim + 16) <= self.broadcast_bytes
            and self.state_bytes() <= self.task_bytes
        )

    def block(self, qids, vectors, bounds) -> QueryBlock:
        return QueryBlock(
            qids, vectors, bounds, self.k, self.metric.name, self.normalize_query, self.query_block
        )

    def at_once(self) -> int:
        """Queries whose lists a task keeps at a time; for more, it holds base rows and passes over the queries."""
        return max(FEWEST_AT_ONCE, STATE_BYTES // (16 * self.dim + 128 * self.k))

    def blocks(self) -> int:
        """Blocks a query set is cut into: as large as a task can hold, with room for skew."""
        by_state = 2 * self.state_bytes() / self.task_bytes
        by_size = 2 * self.n_queries * (4 * self.dim + 16) / self.broadcast_bytes
        return self.query_blocks or max(2, math.ceil(max(by_state, by_size)))

    def pairs(self, base: DataFrame, queries: DataFrame) -> DataFrame:
        """Each task's best ``k`` rows of every query: ``(qid, id, distance)``, without a shuffle."""
        if self.fits_broadcast():
            return base.mapInArrow(_stationary_base(self, queries), PAIRS)
        return base.mapInArrow(_streamed_queries(self, _store_blocks(self, queries)), PAIRS)

    def run(self, base: DataFrame, queries: DataFrame) -> DataFrame:
        return top_k(self.pairs(base, queries), self.k, self.metric)


def kth_bounds(found: DataFrame, k: int, metric: str | Metric) -> DataFrame:
    """``(qid, bound)`` from lists that are full: no better list can end beyond their last distance."""
    worst = -F.col("distance") if get_metric(metric).higher_is_better else F.col("distance")
    # A little wider than needed: bounds only prune.
    return found.where(F.col("rank") == k).select("qid", (worst + F.abs(worst) * 1e-9 + 1e-12).alias("bound"))


def _bounds_from_pilot(
    plan: Search, base: DataFrame, queries: DataFrame, fraction: float
) -> DataFrame:
    pilot = cut_lineage(_pilot_rows(base, fraction), "pilot")
    rows = pilot.count()
    # Few large partitions: each one emits up to k rows per query.
    packed = pilot.repartition(max(1, math.ceil(rows / CELL_ROWS)), "id")
    if rows >= PILOT_FROM:
        queries = _bounds_from_pilot(plan, pilot, queries, PILOT_FRACTION)
    bounds = kth_bounds(plan.run(packed, queries), plan.k, plan.metric).withColumnRenamed("bound", "pilot")
    tighter = F.least("bound", "pilot").alias("bound")  # skips NULL
    return cut_lineage(queries.join(bounds, "qid", "left").select("qid", "vector", tighter), "bounds")


def _pilot_rows(base: DataFrame, fraction: float) -> DataFrame:
    """About ``fraction`` of the base: whole files of it, so that the others are not read at all.

    A base of few files, or one whose rows do not know their file, is sampled row by row. Which rows they are only matters for
    how tight the bounds get.
    """
    if len(base.inputFiles()) >= PILOT_FILES / fraction:
        draw = F.pmod(F.xxhash64(F.col("_metadata.file_path")), F.lit(10_000))
        try:
            return base.where(draw < round(10_000 * fraction))
        except AnalysisException:  # joined or aggregated: no file column to filter on
            pass
    return base.sample(fraction, seed=17)


def _broadcast(queries: DataFrame):
    """(qids, vectors, bounds) for all tasks; the caller has checked the size."""
    table = queries.toArrow()
    qids = table["qid"]
    if qids.null_count or len(qids.unique()) != len(qids):
        raise ValueError(UNIQUE_QIDS)
    bounds = table["bound"].fill_null(float("inf")).to_numpy() if "bound" in queries.columns else None
    return queries.sparkSession.sparkContext.broadcast((qids.to_numpy(), to_matrix(table["vector"]), bounds))


def _stationary_base(plan: Search, queries: DataFrame) -> Callable:
    shared = _broadcast(queries)
    at_once = plan.at_once()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if plan.n_queries <= at_once:
            block = plan.block(*shared.value)
            for batch in batches:
                block.add(batch.column(0).to_numpy(), to_matrix(batch.column(1)), plan.normalize_base)
            yield from block.results()
            return
        qids, vectors, bounds = shared.value
        bounds = np.full(len(qids), np.inf) if bounds is None else bounds.copy()
        for held in _held_runs(batches):
            yield from _compare(plan, at_once, qids, vectors, bounds, held)

    return run


def _held_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Base rows in runs of about ``HELD_BYTES``."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append((batch.column(0).to_numpy(), to_matrix(batch.column(1))))
        size += held[-1][1].nbytes
        if size >= HELD_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _cells(held: list[tuple]) -> Iterator[tuple]:
    """Held rows, small pieces put together: one comparison's size does not grow with what is held."""
    part, n = [], 0
    for piece in held:
        part.append(piece)
        n += len(piece[0])
        if n >= CELL_HELD:
            yield tuple(np.concatenate(c) for c in zip(*part))
            part, n = [], 0
    if part:
        yield tuple(np.concatenate(c) for c in zip(*part))


def _compare(plan: Search, at_once: int, qids, vectors, bounds, held: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Lists of the held rows for all queries, ``at_once`` at a time; ``bounds``, if given, take on the distances found."""
    for lo in range(0, len(qids), at_once):
        own = slice(lo, lo + at_once)
        part = plan.block(qids[own], vectors[own], None if bounds is None else bounds[own])
        for ids, m in _cells(held):
            part.add(ids, m, plan.normalize_base)
        yield from part.results()
        if bounds is not None:
            bounds[own] = part.bounds


def _store_blocks(plan: Search, queries: DataFrame) -> list[str]:
    """Write the queries in hashed blocks a task can hold; returns the blocks' folders."""
    n = plan.blocks()
    path = scratch_path(queries.sparkSession, "queries")
    numbered = queries.withColumn("block", F.pmod(F.xxhash64("qid"), F.lit(n)))
    numbered.repartition(n, "block").write.partitionBy("block").parquet(path)
    return [f"{path}/block={i}" for i in range(n)]


def _read_block(folder: str) -> tuple | None:
    """(qids, vectors, bounds) of a stored block; None if no query fell into it."""
    fs, path = open_fs(folder)
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return None
    table = ds.dataset(path, filesystem=fs, format="parquet").to_table()
    bounds = table["bound"].fill_null(float("inf")).to_numpy().copy() if "bound" in table.column_names else None
    return table["qid"].to_numpy(), to_matrix(table["vector"]), bounds


def _candidates(plan: Search, at_once: int, held: list[tuple], blocks: list[str]) -> Iterator[pa.RecordBatch]:
    """Lists of the held base rows for every query, one stored block after the other."""
    for folder in blocks:
        if (block := _read_block(folder)) is not None:
            yield from _compare(plan, at_once, *block, held)


def _streamed_queries(plan: Search, blocks: list[str]) -> Callable:
    """The base stays where it is read: each task keeps a run of its rows while the query blocks, read
    from the shared folder, stream past."""
    at_once = plan.at_once()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held_runs(batches):
            yield from _candidates(plan, at_once, held, blocks)

    return run


def _per_shard(plan: Search, base: DataFrame, queries: DataFrame, per: str) -> DataFrame:
    """Candidate lists kept apart by ``per``; a sort inside tasks brings a shard's rows together."""
    small = plan.fits_broadcast()
    shared = _broadcast(queries) if small else None
    blocks = [] if small else _store_blocks(plan, queries)
    at_once = plan.at_once()
    whole = small and plan.n_queries <= at_once  # all queries' lists fit, so rows need not be held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, one, held, size = None, None, [], 0

        def found():
            if whole:
                return one.results()
            if small:
                return _compare(plan, at_once, *shared.value[:2], None, held)
            return _candidates(plan, at_once, held, blocks)

        def lists():
            for out in found():
                labels = pa.array(np.full(out.num_rows, shard, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([labels, *out.columns], names=[per, *out.schema.names])

        for batch in batches:
            for key, rows in _runs(batch, 2):
                if shard is not None and (key != shard or size >= HELD_BYTES):
                    yield from lists()
                if shard is None or key != shard or size >= HELD_BYTES:
                    shard, one, held, size = key, plan.block(*shared.value) if whole else None, [], 0
                ids, vectors = rows.column(0).to_numpy(), to_matrix(rows.column(1))
                if whole:
                    one.add(ids, vectors, plan.normalize_base)
                else:
                    held.append((ids, vectors))
                    size += vectors.nbytes
        if shard is not None:
            yield from lists()

    return base.sortWithinPartitions(per).mapInArrow(run, f"{per} long, {PAIRS}")


def _runs(batch: pa.RecordBatch, column: int):
    """Cut a batch wherever ``column`` changes: (value, rows) pairs."""
    if not batch.num_rows:
        return
    keys = batch.column(column).to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
    for lo, hi in zip(edges, edges[1:]):
        yield int(keys[lo]), batch.slice(lo, hi - lo)
