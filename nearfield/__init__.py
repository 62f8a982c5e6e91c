"""Exact nearest-neighbour ground truth and embedding-dataset preparation on Spark."""

from nearfield.functions.metrics import (
    METRICS,
    Metric,
    cosine_distance,
    cosine_similarity,
    l2_normalize,
    l2_sq,
    round_vector,
)
from nearfield.functions.names import base_name, shard_number
from nearfield.operators.assembly import (
    assign_pk,
    audit_shards,
    count_mismatches,
    filter_vectors,
    pending_shards,
    renumber_shards,
    shard_counts,
    zip_shards,
)
from nearfield.operators.balls import knn_balls, write_balls
from nearfield.operators.checks import check_dimension, enforce_schema
from nearfield.operators.coread import zip_in_place
from nearfield.operators.cursor import Cursor, index_pages, page_count, scan_page_at, store_pages
from nearfield.operators.knn import knn
from nearfield.operators.latency import latency_stats
from nearfield.operators.ordinals import with_chunk, with_ordinal, with_page
from nearfield.operators.paging import scan_pages, search_pages
from nearfield.operators.recall import recall, recall_diff, recall_per_query
from nearfield.operators.sampling import sample_queries
from nearfield.operators.topk import merge_topk, to_long, to_wide
from nearfield.sources.json_chunks import export_json_chunks
from nearfield.sources.links import extract_links, link_manifest, shard_names, shard_paths, write_links
from nearfield.sources.tables import (
    list_shards,
    scan_latency,
    scan_neighbors,
    scan_vectors,
    write_clustered,
    write_latency,
    write_neighbors,
    write_vectors,
)
from nearfield.sources.vecfiles import (
    current_folder,
    scan_npy,
    scan_npy_set,
    scan_vecs,
    write_npy,
    write_npy_neighbors,
    write_shards,
    write_vecs,
)
from nearfield.streaming.ingest import ingest_incremental
from nearfield.streaming.neighbors import knn_incremental

__all__ = [
    "Cursor", "METRICS", "Metric", "assign_pk", "audit_shards", "base_name", "check_dimension",
    "cosine_distance", "cosine_similarity", "count_mismatches", "current_folder", "enforce_schema",
    "export_json_chunks", "extract_links", "filter_vectors", "index_pages", "ingest_incremental", "knn",
    "knn_balls", "knn_incremental", "l2_normalize", "l2_sq", "latency_stats", "link_manifest", "list_shards", "merge_topk",
    "page_count", "pending_shards", "recall", "recall_diff", "recall_per_query", "renumber_shards",
    "round_vector", "sample_queries", "scan_latency", "scan_neighbors", "scan_npy", "scan_npy_set", "scan_page_at", "scan_pages",
    "scan_vecs", "scan_vectors", "search_pages", "shard_counts", "shard_names", "shard_number",
    "shard_paths", "store_pages", "to_long", "to_wide", "with_chunk", "with_ordinal", "with_page", "write_balls", "write_clustered", "write_latency",
    "write_links", "write_neighbors", "write_npy", "write_npy_neighbors", "write_shards", "write_vecs", "write_vectors", "zip_in_place", "zip_shards",
]
