"""Ground truth that grows with arriving shards."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield import schemas
from nearfield.functions.metrics import Metric, get_metric
from nearfield.operators.kernel import ROWS_OUT
from nearfield.operators.knn import PAIRS, candidate_pairs, kth_bounds
from nearfield.operators.topk import to_long
from nearfield.session import discard

FILES_PER_STEP = 1_000
COMPACT_FROM = 16  # steps whose lists are kept apart before they are written as one table
TRIM_ROWS = 1 << 18  # candidates a task takes in before it cuts them to the best of each query
LISTS = "qid long, ids array<long>, distances array<double>"


def _fold(k: int, descending: bool):
    """Merge a query's new candidates into its list; a list that stays as it is, is neither stored nor handed on."""

    def run(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        old = state.get if state.exists else ([], [])
        ids, distances = [np.array(old[0], dtype=np.int64)], [np.array(old[1], dtype=np.float64)]
        for part in parts:
            ids.append(part["id"].to_numpy())
            distances.append(part["distance"].to_numpy())
        i, d = np.concatenate(ids), np.concatenate(distances)
        best = np.lexsort((i, -d if descending else d))[:k]
        if len(best) == len(old[0]) and (best < len(old[0])).all():
            return
        i, d = i[best].tolist(), d[best].tolist()
        state.update((i, d))
        yield pd.DataFrame({"qid": [key[0]], "ids": [i], "distances": [d]})

    return run


def _best(held: list[tuple], k: int, descending: bool) -> tuple:
    """The best ``k`` of every query, ties by id."""
    qids, ids, distances = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((ids, -distances if descending else distances, qids))
    qids = qids[order]
    first = np.flatnonzero(np.append(True, np.diff(qids) != 0))
    place = np.arange(len(qids)) - np.repeat(first, np.diff(np.append(first, len(qids))))
    order = order[place < k]
    return qids[place < k], ids[order], distances[order]


def _trim(k: int, descending: bool):
    """Cut candidates to the best ``k`` of each query, so the state sees one short list however many tasks searched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, limit = [], 0, TRIM_ROWS
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(c.to_numpy() for c in batch.columns))
            n += batch.num_rows
            if n >= limit:
                held = [_best(held, k, descending)]
                n = len(held[0][0])
                limit = max(TRIM_ROWS, 2 * n)
        if held:
            qids, ids, distances = _best(held, k, descending)
            for at in range(0, len(qids), ROWS_OUT):
                part = slice(at, at + ROWS_OUT)
                yield pa.RecordBatch.from_arrays([pa.array(c[part]) for c in (qids, ids, distances)], names=["qid", "id", "distance"])

    return run


def knn_incremental(
    spark: SparkSession,
    source_dir: str,
    queries: DataFrame,
    k: int,
    metric: str | Metric,
    state_dir: str,
    *,
    id_col: str = "pk",
    vector_col: str = "vector",
    files_per_step: int = FILES_PER_STEP,
    progress: list | None = None,
    **options,
) -> DataFrame:
    """Fold every new Parquet shard below ``source_dir`` into the running top k.

    New files are taken ``files_per_step`` at a time. The running lists are keyed state of the stream: a step
    touches the queries whose lists it changes, and only these are stored and written. Lists found by earlier
    calls bound the search. Steps of fewer files than the cluster has cores are dealt over the cores by id, and each
    query's candidates are cut to ``k`` before they meet its state. ``options`` go to :func:`candidate_pairs`; ``progress`` gets what Spark reports of each step.

    A step writes the lists it changed to a folder named after it, replaced if the step is repeated; the result
    has each query's latest list. From ``COMPACT_FROM`` folders on they are put together at the end of a call.
    """
    source = spark.readStream.schema(_schema(spark, source_dir)).option("maxFilesPerTrigger", files_per_step).parquet(source_dir)
    tasks = spark.sparkContext.defaultParallelism
    if files_per_step < tasks:
        source = source.repartition(tasks, id_col)
    running = _latest(spark, state_dir)
    bounds = None if running is None else kth_bounds(to_long(_wide(running)), k, metric)
    pairs = candidate_pairs(
        source, queries, k, metric, id_col=id_col, vector_col=vector_col, bounds=bounds, **options
    )
    descending = get_metric(metric).higher_is_better
    best = pairs.repartition("qid").mapInArrow(_trim(k, descending), PAIRS)
    changed = best.groupBy("qid").applyInPandasWithState(
        _fold(k, descending), LISTS, "ids array<long>, distances array<double>", "update", "NoTimeout"
    )

    def save(lists: DataFrame, epoch: int) -> None:
        lists.write.mode("overwrite").parquet(f"{state_dir}/changed/step={epoch}")

    query = (
        changed.writeStream.outputMode("update").foreachBatch(save)
        .option("checkpointLocation", f"{state_dir}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if progress is not None:
        progress.extend(query.recentProgress)
    _compact(spark, state_dir)
    lists = _latest(spark, state_dir)
    if lists is None:
        return spark.createDataFrame([], schemas.NEIGHBORS)
    return to_long(_wide(lists)).select(schemas.NEIGHBORS.fieldNames())


def _schema(spark: SparkSession, source_dir: str):
    return spark.read.parquet(source_dir).schema


def _wide(lists: DataFrame) -> DataFrame:
    return lists.select(F.col("qid").alias("id"), F.col("ids").alias("neighbors_id"), F.col("distances").alias("distance"))


def _steps(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the committed ``step=`` folders."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [f.getPath() for f in fs.listStatus(root)]
    return sorted(int(p.getName().partition("=")[2]) for p in names if fs.exists(hadoop.Path(p, "_SUCCESS")))


def _tables(spark: SparkSession, state_dir: str) -> tuple[list[str], list[str]]:
    """Folders that make up the result, and such that a later compaction replaces."""
    whole, changed = (_steps(spark, f"{state_dir}/{name}") for name in ("whole", "changed"))
    upto = whole[-1] if whole else -1
    used = [f"{state_dir}/whole/step={upto}"] * bool(whole) + [f"{state_dir}/changed/step={n}" for n in changed if n > upto]
    old = [f"{state_dir}/whole/step={n}" for n in whole[:-1]] + [f"{state_dir}/changed/step={n}" for n in changed if n <= upto]
    return used, old


def _latest(spark: SparkSession, state_dir: str) -> DataFrame | None:
    """Each query's latest list."""
    used, _ = _tables(spark, state_dir)
    if not used:
        return None
    parts = [spark.read.schema(LISTS).parquet(path).withColumn("at", F.lit(n)) for n, path in enumerate(used)]
    lists = reduce(DataFrame.unionByName, parts)
    best = F.max_by(F.struct("ids", "distances"), "at").alias("list")
    return lists.groupBy("qid").agg(best).select("qid", "list.ids", "list.distances")


def _compact(spark: SparkSession, state_dir: str) -> None:
    used, old = _tables(spark, state_dir)
    discard(spark, *old)
    if len(used) >= COMPACT_FROM:
        last = used[-1].rpartition("=")[2]
        _latest(spark, state_dir).write.mode("overwrite").parquet(f"{state_dir}/whole/step={last}")
