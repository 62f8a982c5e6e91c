"""Putting keyed vector tables together from shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.operators.ordinals import join_sized, with_ordinal


def filter_vectors(df: DataFrame, expr: str | None) -> DataFrame:
    """Rows matching a SQL predicate; applied before the search, it reaches the scan."""
    return df if expr is None else df.where(F.expr(expr))


def shard_counts(df: DataFrame, shard: str = "shard_no") -> DataFrame:
    """Rows per shard and the total up to and including it, in shard order."""
    counts = df.groupBy(shard).agg(F.count(F.lit(1)).alias("n_rows"))
    return with_ordinal(counts, [shard], "_before", weight="n_rows").select(
        shard, "n_rows", (F.col("_before") + F.col("n_rows")).alias("running_total")
    )


def assign_pk(
    df: DataFrame,
    start: int = 0,
    global_start: int | None = None,
    shard: str = "shard_no",
    row: str | None = "row_index",
    order: list[str | Column] | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Contiguous ``pk`` (and ``pk_global``) in shard order, then row order.

    With ``row``, the position inside the shard, keys are shard offset plus position: one count
    per shard and no sort. Rows that are not numbered 0..n-1 are an error. Known counts
    (``shard``, ``n_rows``), e.g. from file headers, save the counting pass. Without ``row``, pass
    the ``order`` inside a shard; keys are then positions in the sorted table.
    """
    if row is None:
        out = with_ordinal(df, [shard, *(order or [])], "_at")
    else:
        if sizes is None:
            sizes = df.groupBy(shard).agg(
                F.count(F.lit(1)).alias("_n"), F.min(row).alias("_lo"), F.max(row).alias("_hi")
            )
        else:
            sizes = sizes.select(
                shard, F.col("n_rows").alias("_n"), F.lit(0).alias("_lo"), (F.col("n_rows") - 1).alias("_hi")
            )
            sizes = sizes.groupBy(shard).agg(
                F.sum("_n").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.count(F.lit(1)).alias("_given")
            )
            twice = F.raise_error(F.concat(F.lit("two sizes for shard "), F.col(shard).cast("string")))
            sizes = sizes.withColumn("_n", F.when(F.col("_given") > 1, twice).otherwise(F.col("_n"))).drop("_given")
        starts = with_ordinal(sizes, [shard], "_start", weight="_n")
        gap = (F.col("_lo") != 0) | (F.col("_hi") + 1 != F.col("_n"))
        at = F.when(
            gap,
            F.raise_error(F.concat(F.lit("row numbers have gaps in shard "), F.col(shard))),
        ).otherwise(F.col("_start") + F.col(row))
        out = (
            join_sized(df, starts, [shard])
            .withColumn("_at", at.cast("long"))
            .drop("_n", "_lo", "_hi", "_start")
        )
    out = out.withColumn("pk", F.col("_at") + F.lit(start).cast("long"))
    if global_start is not None:
        out = out.withColumn("pk_global", F.col("_at") + F.lit(global_start).cast("long"))
    return out.drop("_at")


def count_mismatches(
    meta: DataFrame,
    vectors: DataFrame,
    shard: str = "shard_no",
    vector_sizes: DataFrame | None = None,
) -> DataFrame:
    """Shards whose metadata and vector row counts differ, a missing side counting 0.

    ``vector_sizes`` (``shard``, ``n_rows``) saves counting the vectors.
    """
    if vector_sizes is None:
        vector_sizes = vectors.groupBy(shard).agg(F.count(F.lit(1)).alias("n_rows"))
    n_meta = meta.groupBy(shard).agg(F.count(F.lit(1)).alias("n_meta"))
    n_vectors = vector_sizes.select(shard, F.col("n_rows").alias("n_vectors"))
    both = n_meta.join(n_vectors, shard, "full").na.fill(0, ["n_meta", "n_vectors"])
    return both.where("n_meta != n_vectors")


def zip_shards(
    meta: DataFrame,
    vectors: DataFrame,
    shard: str = "shard_no",
    row: str = "row_index",
    on_mismatch: str = "fail",
    vector_sizes: DataFrame | None = None,
) -> DataFrame:
    """Join row i of a metadata shard with row i of the vector shard of the same number.

    Shards of unequal length raise, or are left out whole with ``on_mismatch='skip'``.
    """
    if on_mismatch not in ("fail", "skip"):
        raise ValueError("on_mismatch must be 'fail' or 'skip'")
    uneven = count_mismatches(meta, vectors, shard, vector_sizes)
    if on_mismatch == "fail":
        first = uneven.orderBy(shard).first()
        if first is not None:
            raise ValueError(
                f"shard {first[shard]}: {first.n_meta} metadata rows, {first.n_vectors} vectors"
            )
    else:
        # Left out before the rows are shuffled.
        uneven = uneven.select(shard, F.lit(True).alias("_uneven"))
        meta = join_sized(meta, uneven, [shard], "left").where("_uneven IS NULL").drop("_uneven")
    return meta.join(vectors, [shard, row])


def renumber_shards(df: DataFrame, lo: int, hi: int, shard: str = "shard_no") -> DataFrame:
    """Keep shards lo <= number < hi and number them from 0."""
    s = F.col(shard)
    return df.where((s >= lo) & (s < hi)).withColumn(shard, s - F.lit(lo))


def audit_shards(
    expected: DataFrame, present: DataFrame, policy: str = "fail", key: str = "shard"
) -> DataFrame:
    """Expected shards that exist. A missing one raises unless the policy is ``skip``."""
    if policy not in ("fail", "skip"):
        raise ValueError("policy must be 'fail' or 'skip'")
    have = present.select(key).distinct()
    if policy == "fail":
        missing = expected.join(have, key, "left_anti").orderBy(key).first()
        if missing is not None:
            raise FileNotFoundError(f"missing shard {missing[key]}")
    return expected.join(have, key, "left_semi")


def missing_shards(expected: DataFrame, present: DataFrame, key: str = "shard") -> DataFrame:
    return expected.join(present.select(key).distinct(), key, "left_anti")


def pending_shards(shards: DataFrame, manifest: DataFrame, key: str = "shard") -> DataFrame:
    """Shards the manifest does not list yet."""
    return shards.join(manifest.select(key).distinct(), key, "left_anti")
