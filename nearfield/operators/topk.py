"""Top-k per query and the shapes of neighbour lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nearfield.functions.metrics import Metric, get_metric

SALTS = 16


def top_k(
    pairs: DataFrame,
    k: int,
    metric: str | Metric,
    salts: int = SALTS,
    per: str | None = None,
) -> DataFrame:
    """The k best (``qid``, ``id``, ``distance``) rows of every query, ranked from 1.

    With ``per`` the lists are kept apart by that column too. Spark trims each map task to k
    rows per key before it shuffles. The first round keys on (qid, salt), the salt being taken
    from the map task, so one query whose candidates dominate the data is spread over ``salts``
    tasks; the second round sees at most ``salts * k`` rows per query.
    """
    order = get_metric(metric).order()
    keys = [per, "qid"] if per else ["qid"]
    if salts > 1:
        salted = pairs.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        by_salt = Window.partitionBy(*keys, "_salt").orderBy(*order)
        pairs = salted.withColumn("_r", F.row_number().over(by_salt)).where(F.col("_r") <= k)
    by_query = Window.partitionBy(*keys).orderBy(*order)
    return (
        pairs.select(*keys, "id", "distance", F.row_number().over(by_query).alias("rank"))
        .where(F.col("rank") <= k)
        .select(*keys, "rank", "id", "distance")
    )


def merge_topk(
    *parts: DataFrame,
    k: int,
    metric: str | Metric,
    distinct_ids: bool = False,
    salts: int = SALTS,
) -> DataFrame:
    """Merge neighbour lists of any split of the base, or a running result with new parts.

    An id found in several parts counts once per part unless ``distinct_ids`` is set.
    """
    if not parts:
        raise ValueError("merge_topk needs at least one part")
    metric = get_metric(metric)
    pairs = reduce(DataFrame.unionByName, [p.select("qid", "id", "distance") for p in parts])
    if distinct_ids:
        best = F.max("distance") if metric.higher_is_better else F.min("distance")
        pairs = pairs.groupBy("qid", "id").agg(best.alias("distance"))
    return top_k(pairs, k, metric, salts)


def to_wide(neighbors: DataFrame, k: int | None = None) -> DataFrame:
    """One row per query with parallel id and distance lists, best first.

    The lists are as long as the ranked result, so at most k entries reach a group.
    """
    if k is not None:
        neighbors = neighbors.where(F.col("rank") <= k)
    hits = F.array_sort(F.collect_list(F.struct("rank", "id", "distance")))
    return (
        neighbors.groupBy("qid")
        .agg(hits.alias("hits"))
        .select(
            F.col("qid").alias("id"),
            F.col("hits.id").alias("neighbors_id"),
            F.col("hits.distance").alias("distance"),
        )
    )


def to_long(wide: DataFrame) -> DataFrame:
    """Inverse of :func:`to_wide`."""
    zipped = F.arrays_zip(F.col("neighbors_id"), F.col("distance"))
    return wide.select(F.col("id").alias("qid"), F.posexplode(zipped).alias("pos", "hit")).select(
        "qid",
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("hit.neighbors_id").alias("id"),
        F.col("hit.distance").alias("distance"),
    )
