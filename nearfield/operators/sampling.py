"""Reproducible two-stage sampling of a query set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _draw(seed: int, key: str):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_queries(
    df: DataFrame,
    n_shards: int,
    nq: int,
    seed: int = 0,
    *,
    first_shards: int | None = None,
    shard: str = "shard_no",
    key: str = "pk",
) -> DataFrame:
    """Draw ``n_shards`` shards, then ``nq // n_shards`` rows of each.

    ``first_shards`` limits the draw to shards below that number; by default all take part.
    Both draws are without replacement and depend only on the seed and the keys. A shard or a
    pool that is too small is an error. The drawn shard numbers become a filter that reaches the
    scan, and each map task keeps only its best rows per shard.
    """
    per_shard = nq // n_shards if n_shards > 0 else 0
    if per_shard < 1:
        raise ValueError("need at least one shard and one row per shard")
    pool = df if first_shards is None else df.where(F.col(shard) < first_shards)
    picked = (
        pool.groupBy(shard)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(_draw(seed, shard), shard)
        .limit(n_shards)
        .collect()
    )
    if len(picked) < n_shards:
        raise ValueError(f"fewer shards than asked for: {len(picked)} of {n_shards}")
    for row in picked:
        if row.n_rows < per_shard:
            raise ValueError(f"too few rows in shard {row[shard]}: {row.n_rows} of {per_shard}")
    order = Window.partitionBy(shard).orderBy(_draw(seed, key), key)
    return (
        pool.where(F.col(shard).isin([row[shard] for row in picked]))
        .withColumn("_r", F.row_number().over(order))
        .where(F.col("_r") <= per_shard)
        .drop("_r")
    )
