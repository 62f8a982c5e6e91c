"""Views over the given tables and SQL pieces shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

N_SHARDS = 8  # derived shards: equal ranges of the vectors' ids, however many there are


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sharded(df: DataFrame, id_col: str, n_ids: int) -> DataFrame:
    """Add ``shard_no`` and ``row_index``: shards are equal ranges of 0..n_ids-1, continued beyond."""
    shard = F.expr(f"{id_col} * {N_SHARDS} DIV {n_ids}")
    first = F.expr(f"(shard_no * {n_ids} + {N_SHARDS - 1}) DIV {N_SHARDS}")
    return df.withColumn("shard_no", shard).withColumn("row_index", F.col(id_col) - first)


def id_range(spark: SparkSession, sf_dir: str) -> int:
    """One more than the largest vector id."""
    return (table(spark, sf_dir, "embeddings").agg(F.max("vec_id")).first()[0] or 0) + 1


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as a keyed vector table in derived shards."""
    rows = sharded(table(spark, sf_dir, "embeddings"), "vec_id", id_range(spark, sf_dir))
    return rows.select(
        "shard_no",
        "row_index",
        F.col("vec_id").alias("pk"),
        "label",
        F.col("embedding").alias("vector"),
    )


def queries(spark: SparkSession, sf_dir: str, scale: float | None = None) -> DataFrame:
    """Every vector as a query, optionally scaled."""
    v = F.col("embedding")
    if scale is not None:
        v = F.transform(v, lambda x: (x * scale).cast("float"))
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("qid"), v.alias("vector"))


def rounded(df: DataFrame, *columns: str, decimals: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, decimals) for c in columns})


# --- DuckDB -------------------------------------------------------------------------------

def sql_dot(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1]::DOUBLE * p[2]::DOUBLE))"


def sql_l2(a: str, b: str) -> str:
    d = "(p[1]::DOUBLE - p[2]::DOUBLE)"
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: {d} * {d}))"


def sql_norm(v: str) -> str:
    return f"sqrt({sql_dot(v, v)})"


def sql_cosine(a: str, b: str) -> str:
    return f"({sql_dot(a, b)} / ({sql_norm(a)} * {sql_norm(b)}))"


def sql_sharded(id_col: str, columns: str, source: str) -> str:
    return f"""
    SELECT shard_no, {id_col} - (shard_no * n_ids + {N_SHARDS - 1}) // {N_SHARDS} AS row_index, {columns}
    FROM (SELECT *, {id_col} * {N_SHARDS} // n_ids AS shard_no
          FROM {source}, (SELECT max(vec_id) + 1 AS n_ids FROM embeddings))
    """


SQL_VECTORS = sql_sharded("vec_id", "vec_id AS pk, label, embedding AS vector", "embeddings")


def sql_pairs(metric: str, base_where: str = "true", queries_sql: str | None = None) -> str:
    """(shard_no, qid, id, d) for every query and base row."""
    q = queries_sql or "SELECT vec_id AS qid, embedding AS vector FROM embeddings"
    if metric == "l2":
        norm, d = "0", sql_l2("q.vector", "b.vector")
    else:
        norm = sql_norm("vector")
        cos = f"{sql_dot('q.vector', 'b.vector')} / (q.nrm * b.nrm)"
        d = cos if metric == "cosine" else f"greatest(0, 1 - {cos})"
    return f"""
    SELECT b.shard_no, q.qid, b.pk AS id, {d} AS d
    FROM (SELECT *, {norm} AS nrm FROM ({q})) q
    CROSS JOIN (SELECT *, {norm} AS nrm FROM ({SQL_VECTORS}) WHERE {base_where}) b
    """


def sql_ranked(pairs: str, k: int, descending: bool = False, per_shard: bool = False) -> str:
    """Top k of ``pairs``, unrounded."""
    part = "shard_no, qid" if per_shard else "qid"
    d = "d DESC" if descending else "d"
    place = f"row_number() OVER (PARTITION BY {part} ORDER BY {d}, id)"
    return f"SELECT {part}, id, d, {place} AS rank FROM ({pairs}) QUALIFY {place} <= {k}"


def sql_neighbors(
    metric: str,
    k: int,
    base_where: str = "true",
    queries_sql: str | None = None,
    per_shard: bool = False,
) -> str:
    ranked = sql_ranked(
        sql_pairs(metric, base_where, queries_sql), k, metric == "cosine", per_shard
    )
    shard = "shard_no, " if per_shard else ""
    return f"""
    SELECT {shard}qid, CAST(rank AS INTEGER) AS rank, id, round(d, 6) AS distance FROM ({ranked})
    """
