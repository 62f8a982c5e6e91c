"""Schema and shape checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select, reorder and cast to ``schema``."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def unusable(v: Column | str) -> Column:
    """True for a vector with a NULL, NaN or infinite element, and for a NULL vector."""
    v = F.col(v) if isinstance(v, str) else v
    infinity = F.lit(float("inf")).cast("float")
    # array_contains is NULL when it meets NULL elements and no NaN.
    bad = (
        F.coalesce(F.array_contains(v, F.lit(float("nan")).cast("float")), F.lit(True))
        | (F.array_max(v) == infinity)
        | (F.array_min(v) == -infinity)
    )
    return F.when(v.isNull(), True).when(F.size(v) == 0, False).otherwise(bad)


def checked_vector(v: Column | str, dim: int) -> Column:
    """The vector itself; evaluating it raises if it is unusable or not of dimension ``dim``."""
    v = F.col(v) if isinstance(v, str) else v
    return F.when(
        unusable(v) | (F.size(v) != dim),
        F.raise_error(F.lit(f"vector with NULL, NaN or infinite elements, or dimension other than {dim}")),
    ).otherwise(v)


def dimension_report(df: DataFrame, col: str = "vector") -> DataFrame:
    """One row: rows, smallest and largest dimension, NULL vectors, vectors with bad elements.

    NULL, NaN and infinite elements count as bad.
    """
    v = F.col(col)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.size(v)).alias("min_dim"),
        F.max(F.size(v)).alias("max_dim"),
        F.count_if(v.isNull()).alias("null_vectors"),
        F.count_if(v.isNotNull() & unusable(v)).alias("bad_vectors"),
    )


def check_dimension(df: DataFrame, col: str = "vector", dim: int | None = None) -> DataFrame:
    """Return ``df`` if all its vectors have one dimension (``dim`` if given), else raise."""
    r = dimension_report(df, col).first()
    if r.null_vectors or r.bad_vectors:
        raise ValueError(
            f"{col}: {r.null_vectors} NULL vectors, {r.bad_vectors} with NULL, NaN or infinite elements"
        )
    if r.n_rows and (r.min_dim != r.max_dim or (dim is not None and r.min_dim != dim)):
        raise ValueError(f"{col}: dimensions {r.min_dim}..{r.max_dim}, expected {dim or 'one'}")
    return df
