"""Ordered results in pages."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.functions.metrics import Metric, get_metric
from nearfield.operators.assembly import filter_vectors
from nearfield.operators.kernel import Side, to_matrix
from nearfield.operators.ordinals import with_page
from nearfield.session import cut_lineage


def first_rows(df: DataFrame, order: Column, limit: int) -> DataFrame:
    """Rows among which the first ``limit`` by ``order`` (ascending, numeric) certainly are, few others.

    An approximate percentile of the key proposes a bound; a count confirms that enough rows lie at or
    below it, else it is widened. Keys alone are read for that.
    """
    keys = df.select(order.alias("_o"))
    total = keys.count()
    share = min(1.0, 1.2 * limit / max(total, 1) + 1e-4)
    while share < 0.5:
        bound = keys.agg(F.percentile_approx("_o", F.lit(share), F.lit(10_000))).first()[0]
        if bound is not None and keys.where(F.col("_o") <= F.lit(bound)).limit(limit).count() == limit:
            return df.where(order.isNull() | (order <= F.lit(bound)))
        share *= 2
    return df


def scan_pages(
    df: DataFrame,
    expr: str | None,
    batch: int,
    limit: int | None = None,
    key: str = "pk",
    verify: bool = False,
) -> DataFrame:
    """Filtered rows in key order with their page number, up to ``limit`` rows.

    A limit first becomes a bound on the key (see ``first_rows``), so only about that many rows are
    sorted; it is then a test on the position, so no task ever holds the limited rows.
    ``verify`` raises unless exactly ``limit`` rows come out; they are counted by the job that sorts them.
    """
    rows = filter_vectors(df, expr)
    if limit is not None:
        rows = first_rows(rows, F.col(key), limit)
    paged = with_page(rows, [key], batch, limit if verify else None)
    return paged if limit is None else paged.where(F.col("ordinal") < limit)


def distances_to(
    base: DataFrame, query: list[float], metric: str | Metric, vector_col: str = "vector"
) -> DataFrame:
    """(``id``, ``distance``) of every base row to one query vector, in Arrow batches."""
    name = get_metric(metric).name
    q = np.asarray([query], dtype=np.float32)
    if not np.isfinite(q).all():
        raise ValueError("NaN or infinite query element")

    def run(batches):
        target = Side(q, name, False).exact(np.zeros(1, dtype=int))
        for batch in batches:
            m = to_matrix(batch.column(1))
            if not len(m):
                continue
            if m.shape[1] != q.shape[1]:
                raise ValueError(f"base dimension {m.shape[1]}, query dimension {q.shape[1]}")
            x = Side(m, name, False).exact(np.arange(len(m)))
            if name == "l2":
                d = ((x - target) ** 2).sum(axis=1)
            else:
                d = np.clip((x * target).sum(axis=1), -1.0, 1.0)
                if name == "cosine_distance":
                    d = np.maximum(1.0 - d, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(d)], names=["id", "distance"])

    return base.select("id", vector_col).mapInArrow(run, "id long, distance double")


def search_pages(
    base: DataFrame,
    query: list[float],
    metric: str | Metric = "cosine",
    *,
    batch: int,
    limit: int | None = None,
    id_col: str = "pk",
    vector_col: str = "vector",
    verify: bool = False,
) -> DataFrame:
    """The whole ranked list for one query, in pages of exactly ``batch`` rows (the last may be short)."""
    metric = get_metric(metric)
    rows = base.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    # Stored narrow first: the range sort reads its input twice, the vectors are read once.
    measured = cut_lineage(distances_to(rows, query, metric), "distances")
    if limit is not None:
        worst = -F.col("distance") if metric.higher_is_better else F.col("distance")
        measured = first_rows(measured, worst, limit)
    paged = with_page(measured, metric.order(), batch, limit if verify else None)
    if limit is not None:
        paged = paged.where(F.col("ordinal") < limit)
    return paged.select((F.col("ordinal") + 1).alias("rank"), "page", "id", "distance")
