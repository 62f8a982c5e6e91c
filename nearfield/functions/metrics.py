"""Metric definitions and their column expressions.

The expressions work on one row and stay in the JVM. They suit row counts that are already
small (a neighbour list, one query); the all-pairs search uses the block kernel instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Metric:
    name: str
    higher_is_better: bool

    def order(self, distance: str = "distance", id_col: str = "id") -> list[Column]:
        """Best first, ties by ascending id."""
        d = F.col(distance)
        return [d.desc() if self.higher_is_better else d.asc(), F.col(id_col).asc()]


METRICS = {
    "l2": Metric("l2", False),  # squared Euclidean distance
    "cosine": Metric("cosine", True),  # similarity
    "cosine_distance": Metric("cosine_distance", False),  # 1 - similarity
}


def get_metric(metric: str | Metric) -> Metric:
    if isinstance(metric, Metric):
        return metric
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {sorted(METRICS)}")
    return METRICS[metric]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _total(products: Column) -> Column:
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def _dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def _norm(v: Column) -> Column:
    return F.sqrt(_total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def l2_normalize(v: Column | str) -> Column:
    """Scale to unit length; a zero vector stays as it is."""
    v = _col(v)
    scaled = F.transform(
        F.array(F.struct(_norm(v).alias("n"), v.alias("v"))),
        lambda s: F.transform(
            s["v"],
            lambda x: F.when(s["n"] == 0, x.cast("double")).otherwise(x.cast("double") / s["n"]),
        ),
    )
    return scaled[0]


def l2_sq(a: Column | str, b: Column | str) -> Column:
    def term(x: Column, y: Column) -> Column:
        d = x.cast("double") - y.cast("double")
        return d * d

    return _total(F.zip_with(_col(a), _col(b), term))


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """Cosine of the angle; 0 when either vector is zero."""
    a, b = _col(a), _col(b)
    norms = _norm(a) * _norm(b)
    return F.when(norms == 0, F.lit(0.0)).otherwise(_dot(a, b) / norms)


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    return F.greatest(F.lit(0.0), F.lit(1.0) - cosine_similarity(a, b))


def round_vector(v: Column | str, decimals: int = 8) -> Column:
    return F.transform(_col(v), lambda x: F.round(x.cast("double"), decimals))
