"""Statistics of a latency series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.operators.ordinals import join_sized, with_ordinal
from nearfield.session import cut_lineage

# The percentiles reported.
PERCENTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}


def latency_stats(
    df: DataFrame,
    col: str = "cost_ms",
    first_n: int | None = None,
    by: list[str] | None = None,
    seq: str = "seq",
) -> DataFrame:
    """count, avg, p50, p95, p99, sum, min, max; over the first ``first_n`` entries if given.

    Percentiles are exact with linear interpolation between the two neighbouring positions.
    Equal values are counted first and the distinct ones are then placed by range, so neither
    a hot group nor a hot value meets in one task or one hash map.
    """
    by = by or []
    if first_n is not None:
        df = df.where(F.col(seq) < first_n)
    df = df.select(*by, F.lit(0).alias("_all"), F.col(col).cast("double").alias("_v"))
    df = df.where(F.col("_v").isNotNull())
    groups = [*by, "_all"]
    values = df.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_times"))
    # Stored, since both the totals and the percentiles read it.
    placed = cut_lineage(with_ordinal(values, [*groups, "_v"], "_at", weight="_times"), "placed")
    value, times = F.col("_v"), F.col("_times")
    totals = placed.groupBy(*groups).agg(
        F.min("_at").alias("_first"),
        F.sum("_times").alias("n"),
        (F.sum(value * times) / F.sum("_times")).alias("avg"),
        F.sum(value * times).alias("sum"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
    )

    def share(p: float):
        """Weight of a value in percentile ``p``: what it holds of the two positions around it."""
        at = F.lit(p) * (F.col("n") - 1)
        low = F.floor(at)

        def holds(pos):
            return (F.col("_pos") <= pos) & (pos < F.col("_pos") + F.col("_times"))

        return F.when(holds(low), low + 1 - at).otherwise(F.lit(0.0)) + F.when(
            holds(low + 1), at - low
        ).otherwise(F.lit(0.0))

    measured = (
        join_sized(placed, totals, groups)
        .withColumn("_pos", F.col("_at") - F.col("_first"))
        .withColumns({name: share(p) for name, p in PERCENTILES.items()})
    )
    stats = ["n", "avg", "sum", "min", "max"]
    used = " or ".join(f"{name} > 0" for name in PERCENTILES)
    return (
        measured.where(used)
        .groupBy(*by, *stats)
        .agg(*[F.sum(F.when(F.col(name) > 0, F.col("_v") * F.col(name))).alias(name) for name in PERCENTILES])
        .select(*by, *stats, *PERCENTILES)
    )
