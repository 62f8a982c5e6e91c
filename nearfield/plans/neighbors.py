"""Neighbour search, merging and evaluation over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.functions.metrics import cosine_distance, cosine_similarity, l2_normalize, l2_sq
from nearfield.operators.assembly import shard_counts
from nearfield.operators.balls import knn_balls, write_balls
from nearfield.operators.checks import dimension_report
from nearfield.operators.knn import knn
from nearfield.operators.pairs import pair_metrics
from nearfield.operators.recall import recall, recall_diff, recall_per_query
from nearfield.operators.sampling import sample_queries
from nearfield.operators.topk import merge_topk, to_long, to_wide
from nearfield.plans.common import (
    SQL_VECTORS,
    queries,
    rounded,
    sql_cosine,
    sql_l2,
    sql_neighbors,
    sql_norm,
    sql_pairs,
    sql_ranked,
    vectors,
)
from nearfield.session import cut_lineage, scratch_path
from nearfield.sources.tables import scan_neighbors, write_clustered, write_neighbors
from nearfield.sources.vecfiles import (
    scan_npy_neighbors,
    scan_npy_set,
    scan_vecs,
    with_position,
    write_npy,
    write_npy_neighbors,
    write_vecs,
)

K = 10
SHORT = 5  # rows of a shard that is shorter than its lists
FILTER = "label IN (1, 3)"
SOME_LABELS = "label < 5"


def _knn(metric: str, scale: float | None = None, **options):
    def run(spark, sf_dir) -> DataFrame:
        found = knn(vectors(spark, sf_dir), queries(spark, sf_dir, scale), K, metric, **options)
        return rounded(found, "distance")

    return run


def _partials(spark, sf_dir, metric: str) -> DataFrame:
    return knn(vectors(spark, sf_dir), queries(spark, sf_dir), K, metric, per="shard_no")


def merge_parts(spark, sf_dir) -> DataFrame:
    return rounded(merge_topk(_partials(spark, sf_dir, "l2"), k=K, metric="l2"), "distance")


def merge_running(spark, sf_dir) -> DataFrame:
    """A first range of shards, then the rest folded in."""
    parts = cut_lineage(_partials(spark, sf_dir, "l2"), "partials")
    earlier = F.col("shard_no") < 4
    running = merge_topk(parts.where(earlier), k=K, metric="l2")
    return rounded(merge_topk(running, parts.where(~earlier), k=K, metric="l2"), "distance")


def merge_similarity(spark, sf_dir) -> DataFrame:
    return rounded(merge_topk(_partials(spark, sf_dir, "cosine"), k=K, metric="cosine"), "distance")


def merge_distinct(spark, sf_dir) -> DataFrame:
    """The same parts given twice count once."""
    parts = cut_lineage(_partials(spark, sf_dir, "l2"), "partials")
    return rounded(merge_topk(parts, parts, k=K, metric="l2", distinct_ids=True), "distance")


def stored_partials(spark, sf_dir) -> DataFrame:
    """Partial lists written by shard and read back."""
    path = scratch_path(spark, "neighbors")
    found = knn(vectors(spark, sf_dir), queries(spark, sf_dir), K, "l2", per="shard_no")
    write_neighbors(found, path, group="shard_no")
    return rounded(scan_neighbors(spark, path), "distance")


def merged_files(spark, sf_dir) -> DataFrame:
    """Partial lists saved as a matrix of (id, distance) pairs per shard, each in parts, read back and merged."""
    path = scratch_path(spark, "matrices")
    write_npy_neighbors(_partials(spark, sf_dir, "l2"), path, K, group="shard_no", part_bytes=1 << 16)
    return rounded(merge_topk(scan_npy_neighbors(spark, path), k=K, metric="l2"), "distance")


def wide(spark, sf_dir) -> DataFrame:
    lists = to_wide(knn(vectors(spark, sf_dir), queries(spark, sf_dir), K, "l2"))
    micro = F.transform("distance", lambda d: F.round(d * 1e6, 0).cast("long").cast("string"))
    return lists.select(
        "id",
        F.array_join(F.transform("neighbors_id", lambda x: x.cast("string")), ",").alias("neighbors_id"),
        F.array_join(micro, ",").alias("distance_micro"),
    )


def long_again(spark, sf_dir) -> DataFrame:
    lists = to_wide(knn(vectors(spark, sf_dir), queries(spark, sf_dir), K, "l2"))
    return rounded(to_long(lists), "distance")


def clustered_filter(spark, sf_dir) -> DataFrame:
    """A filtered search over a copy that is clustered by the filter's attribute."""
    path = scratch_path(spark, "clustered")
    write_clustered(vectors(spark, sf_dir), path, ["label"])
    return rounded(knn(spark.read.parquet(path), queries(spark, sf_dir), K, "l2", expr=FILTER), "distance")


def ball_pruned(spark, sf_dir) -> DataFrame:
    """Search over stored blocks, leaving out those the triangle inequality rules out."""
    stored = write_balls(vectors(spark, sf_dir), scratch_path(spark, "balls"), block_rows=256)
    return rounded(knn_balls(stored, queries(spark, sf_dir), K), "distance")


def _evaluated(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """True lists, the lists a search restricted by an attribute finds, and the queries."""
    base, qs = vectors(spark, sf_dir), queries(spark, sf_dir)
    return knn(base, qs, K, "l2"), knn(base, qs, K, "l2", expr=SOME_LABELS), qs


def truth_files(spark, sf_dir) -> DataFrame:
    """Ids and distances as binary files in query order, read back row by row."""
    path = scratch_path(spark, "truth")
    lists = cut_lineage(to_wide(knn(vectors(spark, sf_dir), queries(spark, sf_dir), K, "l2")), "lists")
    write_vecs(lists, "id", f"{path}/ids", "ivecs", "neighbors_id")
    write_vecs(lists, "id", f"{path}/distances", "fvecs", "distance")

    def scan(kind: str, name: str) -> DataFrame:
        found = with_position(scan_vecs(spark, f"{path}/{name}", kind))
        return found.select(F.col("position").alias("row"), F.col("vector").alias(name))

    return scan("ivecs", "ids").join(scan("fvecs", "distances"), "row").select(
        "row", F.posexplode(F.arrays_zip("ids", "distances")).alias("pos", "hit")
    ).select("row", "pos", F.col("hit.ids").alias("id"), F.round(F.col("hit.distances").cast("double"), 4).alias("distance"))


def recall_at_k(spark, sf_dir) -> DataFrame:
    return recall(*_evaluated(spark, sf_dir))


def recall_by_query(spark, sf_dir) -> DataFrame:
    return rounded(recall_per_query(*_evaluated(spark, sf_dir)), "recall")


def recall_extra(spark, sf_dir) -> DataFrame:
    truth, result, _ = _evaluated(spark, sf_dir)
    return recall_diff(truth, result)


def filter_hits(spark, sf_dir) -> DataFrame:
    return shard_counts(vectors(spark, sf_dir).where(FILTER))


def sampled(spark, sf_dir) -> DataFrame:
    return sample_queries(vectors(spark, sf_dir), 3, 30, seed=7).select("shard_no", "pk")


def query_file_truth(spark, sf_dir) -> DataFrame:
    """A drawn query set written as a matrix in parts, read by place, and searched for."""
    base, path = vectors(spark, sf_dir), scratch_path(spark, "query")
    write_npy(sample_queries(base, 3, 30, seed=7), "pk", path, min_parts=3)
    return rounded(knn(base, scan_npy_set(spark, path), K, "l2"), "distance")


def small_shards(spark, sf_dir) -> DataFrame:
    """Lists longer than a shard: a drawn query set against many shards of few rows each, all rows taken."""
    base = vectors(spark, sf_dir)
    drawn = sample_queries(base, 3, 12, seed=7).select(F.col("pk").alias("qid"), "vector")
    found = knn(base.withColumn("shard_no", F.expr(f"pk DIV {SHORT}")), drawn, K, "l2", per="shard_no")
    return rounded(found, "distance")


def recall_at_5(spark, sf_dir) -> DataFrame:
    """Both lists cut below their length."""
    return recall(*_evaluated(spark, sf_dir), k=5)


def sampled_truth(spark, sf_dir) -> DataFrame:
    base = vectors(spark, sf_dir)
    drawn = sample_queries(base, 3, 30, seed=7).select(F.col("pk").alias("qid"), "vector")
    return rounded(knn(base, drawn, K, "cosine"), "distance")


def _found_pairs(spark, sf_dir, k: int) -> DataFrame:
    """Every found pair joined back to both vectors."""
    base = vectors(spark, sf_dir)
    found = knn(base, queries(spark, sf_dir), k, "l2").select("qid", "id")
    return found.join(base.select(F.col("pk").alias("qid"), F.col("vector").alias("a")), "qid").join(
        base.select(F.col("pk").alias("id"), F.col("vector").alias("b")), "id"
    )


def measured_pairs(spark, sf_dir) -> DataFrame:
    """All metrics of every found pair, in Arrow batches."""
    metrics = ["l2", "similarity", "cosine_distance", "l2_normalized"]
    return rounded(pair_metrics(_found_pairs(spark, sf_dir, K)).select("qid", "id", *metrics), *metrics)


def measured_columns(spark, sf_dir) -> DataFrame:
    """The metrics as column expressions, on every vector and its two nearest."""
    pairs = _found_pairs(spark, sf_dir, 2)
    half = F.transform("b", lambda x: x / 2)
    return rounded(
        pairs.select(
            "qid",
            "id",
            l2_sq("a", "b").alias("l2"),
            cosine_similarity("a", "b").alias("similarity"),
            cosine_distance("a", "b").alias("cosine_distance"),
            l2_sq(l2_normalize("a"), l2_normalize(half)).alias("l2_normalized"),
        ),
        "l2", "similarity", "cosine_distance", "l2_normalized",
    )


def dimensions(spark, sf_dir) -> DataFrame:
    return dimension_report(vectors(spark, sf_dir))


SQL_TRUTH = sql_ranked(sql_pairs("l2"), K)
SQL_RESULT = sql_ranked(sql_pairs("l2", SOME_LABELS), K)
SQL_RECALL = f"""
    SELECT r.qid, count(*) AS n_result,
           count(DISTINCT CASE WHEN t.id IS NOT NULL THEN r.id END) AS n_found,
           n_found / n_result AS recall
    FROM ({SQL_RESULT}) r LEFT JOIN ({SQL_TRUTH}) t ON t.qid = r.qid AND t.id = r.id
    GROUP BY r.qid
"""


def sql_sample(n_shards: int, per_shard: int, seed: int) -> str:
    return f"""
    SELECT * FROM ({SQL_VECTORS})
    WHERE shard_no IN (
        SELECT shard_no FROM (SELECT DISTINCT shard_no FROM ({SQL_VECTORS}))
        ORDER BY md5('{seed}:' || shard_no), shard_no LIMIT {n_shards})
    QUALIFY row_number() OVER (PARTITION BY shard_no ORDER BY md5('{seed}:' || pk), pk) <= {per_shard}
    """


SAMPLE = sql_sample(3, 10, 7)
SMALL_PAIRS = sql_pairs("l2", queries_sql=f"SELECT pk AS qid, vector FROM ({sql_sample(3, 4, 7)})")
DOUBLED = """
    SELECT vec_id AS qid, list_transform(embedding, lambda x: (x * 2)::FLOAT) AS vector FROM embeddings
"""
SQL_NORMALIZED = f"""
    SELECT qid, CAST(rank AS INTEGER) AS rank, id, round(d, 6) AS distance FROM ({sql_ranked(f'''
        SELECT q.qid, b.vec_id AS id, {sql_l2("q.vector", "b.unit")} AS d
        FROM ({DOUBLED}) q CROSS JOIN (
            SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE / n) AS unit
            FROM (SELECT vec_id, embedding, {sql_norm("embedding")} AS n FROM embeddings)) b
    ''', K)})
"""

def sql_metrics(found: str) -> str:
    return f"""WITH found AS ({found}),
            pairs AS (
                SELECT f.qid, f.id, x.embedding AS a, y.embedding AS b,
                       {sql_norm("x.embedding")} AS na, {sql_norm("y.embedding")} AS nb
                FROM found f JOIN embeddings x ON x.vec_id = f.qid JOIN embeddings y ON y.vec_id = f.id)
            SELECT qid, id, round({sql_l2("a", "b")}, 6) AS l2,
                   round({sql_cosine("a", "b")}, 6) AS similarity,
                   round(greatest(0, 1 - {sql_cosine("a", "b")}), 6) AS cosine_distance,
                   round(list_sum(list_transform(list_zip(a, b), lambda p:
                       (p[1]::DOUBLE / na - p[2]::DOUBLE / nb) * (p[1]::DOUBLE / na - p[2]::DOUBLE / nb))), 6)
                       AS l2_normalized
            FROM pairs"""


QUERIES = {
    "knn_l2_top10": (_knn("l2"), sql_neighbors("l2", K)),
    "knn_cosine_top10": (_knn("cosine"), sql_neighbors("cosine", K)),
    "knn_cosine_distance_top10": (_knn("cosine_distance"), sql_neighbors("cosine_distance", K)),
    "knn_two_way_top10": (_knn("l2", query_blocks=4), sql_neighbors("l2", K)),
    "knn_pruned_top10": (_knn("cosine", prune_fraction=0.25), sql_neighbors("cosine", K)),
    "knn_ball_pruned": (ball_pruned, sql_neighbors("l2", K)),
    "knn_filtered": (_knn("l2", expr=FILTER), sql_neighbors("l2", K, FILTER)),
    "knn_filtered_clustered": (clustered_filter, sql_neighbors("l2", K, FILTER)),
    "knn_normalized_base": (_knn("l2", scale=2.0, normalize_base=True), SQL_NORMALIZED),
    "knn_shard_partial": (_knn("l2", per="shard_no"), sql_neighbors("l2", K, per_shard=True)),
    "knn_two_way_per_shard": (
        _knn("l2", per="shard_no", query_blocks=3),
        sql_neighbors("l2", K, per_shard=True),
    ),
    "knn_small_shard": (
        small_shards,
        f"""SELECT shard_no, qid, CAST(rank AS INTEGER) AS rank, id, round(d, 6) AS distance FROM ({sql_ranked(
            f"SELECT id // {SHORT} AS shard_no, qid, id, d FROM ({SMALL_PAIRS})", K, per_shard=True)})""",
    ),
    "query_file_truth": (
        query_file_truth,
        sql_neighbors(
            "l2", K, queries_sql=f"SELECT row_number() OVER (ORDER BY pk) - 1 AS qid, vector FROM ({SAMPLE})"
        ),
    ),
    "recall_at_smaller_k": (
        recall_at_5,
        f"""SELECT count(*) AS n_queries, round(avg(recall), 3) AS recall FROM (
                SELECT r.qid, count(DISTINCT t.id) / count(*) AS recall
                FROM (FROM ({SQL_RESULT}) WHERE rank <= 5) r
                LEFT JOIN (FROM ({SQL_TRUTH}) WHERE rank <= 5) t ON t.qid = r.qid AND t.id = r.id
                GROUP BY r.qid)""",
    ),
    "knn_merge_topk": (merge_parts, sql_neighbors("l2", K)),
    "knn_merge_incremental": (merge_running, sql_neighbors("l2", K)),
    "knn_merge_similarity": (merge_similarity, sql_neighbors("cosine", K)),
    "knn_merge_distinct": (merge_distinct, sql_neighbors("l2", K)),
    "neighbors_stored": (
        stored_partials,
        f"SELECT qid, rank, id, distance FROM ({sql_neighbors('l2', K, per_shard=True)})",
    ),
    "merge_npy_partials": (merged_files, sql_neighbors("l2", K)),
    "neighbors_wide": (
        wide,
        f"""SELECT qid AS id, string_agg(id::VARCHAR, ',' ORDER BY rank) AS neighbors_id,
                   string_agg(round(d * 1e6)::BIGINT::VARCHAR, ',' ORDER BY rank) AS distance_micro
            FROM ({SQL_TRUTH}) GROUP BY qid""",
    ),
    "ground_truth_files": (
        truth_files,
        f"""SELECT dense_rank() OVER (ORDER BY qid) - 1 AS row, CAST(rank - 1 AS INTEGER) AS pos,
                   CAST(id AS INTEGER) AS id, round(d::FLOAT::DOUBLE, 4) AS distance
            FROM ({SQL_TRUTH})""",
    ),
    "neighbors_long": (long_again, sql_neighbors("l2", K)),
    "recall_at_k": (
        recall_at_k,
        f"SELECT count(*) AS n_queries, round(avg(recall), 3) AS recall FROM ({SQL_RECALL})",
    ),
    "recall_per_query": (
        recall_by_query,
        f"SELECT qid, n_result, n_found, round(recall, 6) AS recall FROM ({SQL_RECALL})",
    ),
    "recall_extra_ids": (
        recall_extra,
        f"""SELECT qid, id FROM ({SQL_RESULT}) r
            WHERE NOT EXISTS (FROM ({SQL_TRUTH}) t WHERE t.qid = r.qid AND t.id = r.id)""",
    ),
    "filter_hits_per_shard": (
        filter_hits,
        f"""SELECT shard_no, count(*) AS n_rows,
                   CAST(sum(count(*)) OVER (ORDER BY shard_no) AS BIGINT) AS running_total
            FROM ({SQL_VECTORS}) WHERE {FILTER} GROUP BY shard_no""",
    ),
    "sample_queries": (sampled, f"SELECT shard_no, pk FROM ({SAMPLE})"),
    "knn_sampled_queries": (
        sampled_truth,
        sql_neighbors("cosine", K, queries_sql=f"SELECT pk AS qid, vector FROM ({SAMPLE})"),
    ),
    "neighbor_metrics": (measured_pairs, sql_metrics(SQL_TRUTH)),
    "neighbor_metrics_columns": (measured_columns, sql_metrics(sql_ranked(sql_pairs("l2"), 2))),
    "dimension_check": (
        dimensions,
        """SELECT count(*) AS n_rows, CAST(min(len(embedding)) AS INTEGER) AS min_dim,
                  CAST(max(len(embedding)) AS INTEGER) AS max_dim,
                  count(*) FILTER (embedding IS NULL) AS null_vectors,
                  count(*) FILTER (len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0)
                      AS bad_vectors
           FROM embeddings""",
    ),
}
