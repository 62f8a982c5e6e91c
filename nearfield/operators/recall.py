"""How much of the true neighbour lists a result found."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recall_per_query(
    truth: DataFrame, result: DataFrame, queries: DataFrame, k: int | None = None
) -> DataFrame:
    """Distinct true ids found over the length of the result list, for every query.

    With ``k`` both lists are cut at that rank. A query without any result is an error.
    Lists, marks and queries go through one union and two aggregations, both of which combine
    on the map side, so a query with a very long list does not load one task.
    """
    if k is not None:
        truth, result = truth.where(F.col("rank") <= k), result.where(F.col("rank") <= k)

    def marked(df: DataFrame, in_truth: int, in_result: int) -> DataFrame:
        ids = F.col("id") if "id" in df.columns else F.lit(None).cast("long").alias("id")
        return df.select("qid", ids, F.lit(in_truth).alias("t"), F.lit(in_result).alias("r"))

    rows = (
        marked(truth, 1, 0)
        .unionByName(marked(result, 0, 1))
        .unionByName(marked(queries.select("qid"), 0, 0).withColumn("asked", F.lit(1)), True)
    )
    per_id = rows.groupBy("qid", "id").agg(
        F.max("t").alias("t"), F.sum("r").alias("r"), F.max("asked").alias("asked")
    )
    per_query = per_id.groupBy("qid").agg(
        F.sum("r").alias("n_result"),
        F.count_if((F.col("t") == 1) & (F.col("r") > 0)).alias("n_found"),
        F.max("asked").alias("asked"),
    )
    checked = F.when(
        F.col("n_result") == 0,
        F.raise_error(F.concat(F.lit("no result for query "), F.col("qid").cast("string"))),
    ).otherwise(F.col("n_found") / F.col("n_result"))
    return per_query.where(F.col("asked") == 1).select(
        "qid", "n_result", "n_found", checked.cast("double").alias("recall")
    )


def recall(
    truth: DataFrame, result: DataFrame, queries: DataFrame, k: int | None = None
) -> DataFrame:
    """One row: mean recall over the queries, to three decimals."""
    return recall_per_query(truth, result, queries, k).agg(
        F.count(F.lit(1)).alias("n_queries"), F.round(F.avg("recall"), 3).alias("recall")
    )


def recall_diff(truth: DataFrame, result: DataFrame) -> DataFrame:
    """Ids in a result list that are not in the true list of the same query."""
    return result.select("qid", "id").distinct().join(
        truth.select("qid", "id"), ["qid", "id"], "left_anti"
    )
