"""Positions, chunks and pages over a sorted result, without a single-task window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nearfield.session import cut_lineage

# A side up to this many rows of a few scalar columns is broadcast (tens of MB).
BROADCAST_ROWS = 500_000
ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def join_sized(df: DataFrame, side: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a usually small ``side``: counted first, broadcast only below ``BROADCAST_ROWS``.

    Above that it is an ordinary shuffle join, where AQE splits skewed keys. Keys compare
    null-safe.
    """
    side = cut_lineage(side, "side")
    named = side.select(
        *[F.col(c).alias(f"_on_{c}") for c in on], *[c for c in side.columns if c not in on]
    )
    if side.count() <= BROADCAST_ROWS:
        named = F.broadcast(named)
    match = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    return df.join(named, match, how).drop(*[f"_on_{c}" for c in on])


def running_offsets(counts: DataFrame, order: str, size: str, name: str) -> DataFrame:
    """Total ``size`` of all earlier rows. For tables with one row per shard or partition only."""
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long"))


def with_ordinal(
    df: DataFrame,
    order: list[str | Column],
    name: str = "ordinal",
    by: list[str] | None = None,
    weight: str | None = None,
    at_least: int | None = None,
) -> DataFrame:
    """Add each row's position, from 0, in the total order ``order`` (within ``by`` if given).

    ``order`` should end in a unique column; that makes positions repeatable and lets range
    partitioning split a hot leading key. Each task numbers its own sorted range; the ranges'
    sizes then give every range its start. A row with a ``weight`` stands for that many
    positions and gets its first one. With ``at_least``, fewer rows raise; the job that stores the sorted rows counts them in passing.
    """
    by = by or []
    keys = [F.col(c) for c in by] + [F.col(c) if isinstance(c, str) else c for c in order]
    # Range bounds come from a sample, so the sorted rows are written once before any count.
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    if at_least is not None:
        seen = Observation()
        placed = placed.observe(seen, F.count(F.lit(1)).alias("n"))
    placed = cut_lineage(placed, "ordinal").withColumn("_range", F.shiftright("_place", ROW_BITS))
    if at_least is not None and seen.get["n"] < at_least:
        raise ValueError(f"placed {seen.get['n']} rows, expected {at_least}")
    if weight is None:
        size = F.count(F.lit(1))
        placed = placed.withColumn("_row", F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
    else:
        size = F.sum(weight)
        earlier = Window.partitionBy("_range").orderBy("_place").rowsBetween(
            Window.unboundedPreceding, -1
        )
        placed = placed.withColumn("_row", F.coalesce(F.sum(weight).over(earlier), F.lit(0)))
    sizes = placed.groupBy("_range").agg(size.alias("_n"))
    starts = running_offsets(sizes, "_range", "_n", "_start").select("_range", "_start")
    # One row per range, of which there are at most spark.sql.shuffle.partitions.
    out = placed.join(F.broadcast(starts), "_range").withColumn(name, F.col("_start") + F.col("_row"))
    if by:
        first = out.groupBy(*by).agg(F.min(name).alias("_first"))
        out = join_sized(out, first, by).withColumn(name, F.col(name) - F.col("_first"))
    return out.select(*df.columns, F.col(name).cast("long").alias(name))


def with_chunk(
    df: DataFrame,
    n: int,
    group: list[str],
    order: list[str | Column] | None = None,
    shard: str | None = None,
    row: str | None = None,
) -> DataFrame:
    """Number fixed-size chunks inside each file group; only a group's last chunk is short.

    Rows that know their file (``shard``) and position in it (``row``) need one count per file;
    otherwise they are sorted by ``order``.
    """
    if row is None:
        placed = with_ordinal(df, order, "ord", by=group)
    else:
        sizes = df.groupBy(*group, shard).agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy(*group).orderBy(shard).rowsBetween(
            Window.unboundedPreceding, -1
        )
        starts = sizes.select(*group, shard, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
        placed = join_sized(df, starts, [*group, shard]).withColumn("ord", F.col("_start") + F.col(row))
        placed = placed.select(*df.columns, F.col("ord").cast("long").alias("ord"))
    return placed.withColumn("chunk", F.floor(F.col("ord") / n).cast("long"))


def with_page(df: DataFrame, order: list[str | Column], batch: int, at_least: int | None = None) -> DataFrame:
    """Number pages of ``batch`` rows over the ordered result; fewer rows than ``at_least`` raise."""
    placed = with_ordinal(df, order, "ordinal", at_least=at_least)
    return placed.withColumn("page", F.floor(F.col("ordinal") / batch).cast("long"))
