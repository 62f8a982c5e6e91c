"""Paging, export, latency series, links and binary files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nearfield.functions.names import base_name, shard_number
from nearfield.operators.cursor import Cursor, index_pages, page_count, scan_page_at, store_pages
from nearfield.operators.latency import latency_stats
from nearfield.operators.ordinals import with_chunk, with_ordinal
from nearfield.operators.paging import scan_pages, search_pages
from nearfield.plans.common import (
    SQL_VECTORS,
    queries,
    rounded,
    sql_cosine,
    sql_neighbors,
    table,
    vectors,
)
from nearfield.session import scratch_path
from nearfield.sources.json_chunks import export_json_chunks
from nearfield.sources.links import extract_links, link_manifest, shard_names, shard_paths, write_links
from nearfield.sources.tables import scan_latency, write_latency
from nearfield.sources.vecfiles import current_folder, scan_npy, scan_vecs, with_position, write_npy, write_vecs
from nearfield.streaming.neighbors import knn_incremental

PAGE_ROWS = 1000
CHUNK_ROWS = 100
SHARDS_PER_GROUP = 4
LINK_BASE = "https://data.example.org/vectors/"
LINK_KINDS = {"metadata": "metadata/metadata_%04d.parquet", "vector": "parts/part_%04d.npy"}


def paged_scan(spark, sf_dir) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return scan_pages(events, "event_id >= 0", PAGE_ROWS, key="event_id")


def paged_scan_limited(spark, sf_dir) -> DataFrame:
    """The first rows only, their number verified."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return scan_pages(events, "event_id >= 5", 7, limit=40, key="event_id", verify=True)


def paged_search_limited(spark, sf_dir) -> DataFrame:
    base = vectors(spark, sf_dir)
    query = base.orderBy("pk").select("vector").first()[0]
    return rounded(search_pages(base, query, "cosine", batch=7, limit=40, verify=True), "distance")


def shard_files(spark, sf_dir) -> DataFrame:
    """Paths of every derived shard, and of the pieces inside it."""
    top = vectors(spark, sf_dir).agg(F.max("shard_no")).first()[0]
    return shard_paths(spark, "passage_%02d-%d.parquet", 1, top + 1, 3)


def paged_search(spark, sf_dir) -> DataFrame:
    """The table's first vector is the query, as in a query file read from its start."""
    base = vectors(spark, sf_dir)
    query = base.orderBy("pk").select("vector").first()[0]
    return rounded(search_pages(base, query, "cosine", batch=CHUNK_ROWS), "distance")


def _some_pages(spark, cursor: Cursor, columns: list[str] | None = None) -> DataFrame:
    """The middle page, the page its token leads to, and the last one; each is read by itself."""
    last = page_count(spark, cursor.index) - 1
    page, after = scan_page_at(spark, Cursor(cursor.index, last // 2), columns)
    found = [page]
    if after is not None and after.page < last:
        found.append(scan_page_at(spark, Cursor.of(after.token()), columns)[0])
    if last > last // 2:
        found.append(scan_page_at(spark, Cursor(cursor.index, last), columns)[0])
    return reduce(DataFrame.unionByName, found)


def pages_at(spark, sf_dir) -> DataFrame:
    events = table(spark, sf_dir, "events")
    cursor = index_pages(events, scratch_path(spark, "index"), PAGE_ROWS, "event_id", "event_id >= 0")
    return _some_pages(spark, cursor, ["event_id", "user_id", "event_type"])


def found_pages_at(spark, sf_dir) -> DataFrame:
    """Pages of a stored search."""
    base = vectors(spark, sf_dir)
    query = base.orderBy("pk").select("vector").first()[0]
    pages = search_pages(base, query, "cosine", batch=CHUNK_ROWS)
    cursor = store_pages(pages, scratch_path(spark, "found"), CHUNK_ROWS)
    return rounded(_some_pages(spark, cursor).drop("ordinal"), "distance")


def _grouped(spark, sf_dir) -> DataFrame:
    rows = vectors(spark, sf_dir)
    return rows.select(
        F.floor(F.col("shard_no") / SHARDS_PER_GROUP).cast("long").alias("grp"),
        "shard_no", "row_index", "pk", F.col("vector").alias("float32_vector"),
    )


def chunked(spark, sf_dir) -> DataFrame:
    """Chunk numbers from file offsets."""
    rows = _grouped(spark, sf_dir).select("grp", "shard_no", "row_index", "pk")
    return with_chunk(rows, CHUNK_ROWS, ["grp"], shard="shard_no", row="row_index")


def chunked_by_order(spark, sf_dir) -> DataFrame:
    """Chunk numbers from the sort order inside each source."""
    docs = table(spark, sf_dir, "documents").select("source", "doc_id")
    return with_chunk(docs, 40, ["source"], order=["doc_id"])


def exported(spark, sf_dir) -> DataFrame:
    """Documents written as text, then parsed line by line."""
    path = scratch_path(spark, "json")
    export_json_chunks(_grouped(spark, sf_dir), path, CHUNK_ROWS, shard="shard_no", row="row_index")
    lines = spark.read.text(current_folder(path)).withColumn(
        "chunk", F.regexp_extract(F.col("_metadata.file_name"), r"chunk-(\d+)", 1)
    )
    body = F.regexp_replace("value", r'^\{"rows":\[|(,|\]\})$', "")
    row = F.from_json(body, "pk long, float32_vector array<double>")
    parsed = lines.select(
        F.col("grp").cast("long").alias("grp"),
        F.col("chunk").cast("long").alias("chunk"),
        F.startswith("value", F.lit('{"rows":[')).alias("opens"),
        F.endswith("value", F.lit("]}")).alias("closes"),
        row.alias("row"),
    )
    return parsed.select(
        "grp", "chunk", "opens", "closes", "row.pk", F.posexplode("row.float32_vector").alias("pos", "value")
    ).select("*", F.round(F.col("value") * 1e8).cast("long").alias("value_e8")).drop("value")


def latency(spark, sf_dir) -> DataFrame:
    stats = latency_stats(table(spark, sf_dir, "events"), "value", by=["event_type"])
    return rounded(stats, "avg", "sum", "min", "max", "p50", "p95", "p99")


def latency_prefix(spark, sf_dir) -> DataFrame:
    """The first 150 entries of every series."""
    place = F.row_number().over(Window.partitionBy("event_type").orderBy("ts", "event_id"))
    series = table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value")
    series = series.withColumn("place", place).where("place <= 150").withColumn("seq", F.col("place").cast("long") - 1)
    stats = latency_stats(series, "value", first_n=150, by=["event_type"])
    return rounded(stats, "avg", "sum", "min", "max", "p50", "p95", "p99")


def latency_file(spark, sf_dir) -> DataFrame:
    """A series written one number per line and read back in order."""
    path = scratch_path(spark, "latency")
    events = table(spark, sf_dir, "events")
    write_latency(events.select(F.col("event_id").alias("seq"), F.col("value").alias("cost_ms")), path)
    return scan_latency(spark, path)


def _shard_numbers(spark, sf_dir) -> DataFrame:
    return vectors(spark, sf_dir).select("shard_no").distinct()


def named_shards(spark, sf_dir) -> DataFrame:
    numbers = _shard_numbers(spark, sf_dir).select(
        "shard_no", F.explode(F.array(*[F.lit(j).cast("long") for j in range(4)])).alias("part")
    )
    return shard_names(numbers, "passage_%02d-%d.parquet", ["shard_no", "part"])


def links(spark, sf_dir) -> DataFrame:
    """Generated links, written and read back as text."""
    path = scratch_path(spark, "links")
    write_links(link_manifest(_shard_numbers(spark, sf_dir), LINK_BASE, LINK_KINDS, "shard_no"), path)
    return spark.read.text(path).select(F.col("value").alias("url"))


def page_links(spark, sf_dir) -> DataFrame:
    return extract_links(table(spark, sf_dir, "pages"), "/")


def numbers_in_names(spark, sf_dir) -> DataFrame:
    found = link_manifest(_shard_numbers(spark, sf_dir), LINK_BASE, LINK_KINDS, "shard_no")
    return found.select("url", base_name("url").alias("file"), shard_number("url").alias("number"))


def vec_files(spark, sf_dir) -> DataFrame:
    """Vectors and their ids written in one order, read back and joined by position."""
    path = scratch_path(spark, "vecs")
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.array("vec_id", F.col("label").cast("long")).alias("ids"), "embedding"
    )
    write_vecs(rows, "vec_id", f"{path}/f", "fvecs", "embedding")
    write_vecs(rows, "vec_id", f"{path}/i", "ivecs", "ids")

    def scan(kind: str, name: str) -> DataFrame:
        found = with_position(scan_vecs(spark, f"{path}/{name}", kind, split_bytes=1 << 16))
        return found.select("position", F.col("vector").alias(kind))

    both = scan("ivecs", "i").join(scan("fvecs", "f"), "position")
    return both.select(
        F.col("ivecs")[0].alias("vec_id"), F.col("ivecs")[1].alias("label"),
        F.posexplode("fvecs").alias("pos", "value"),
    )


def npy_files(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "npy")
    write_npy(table(spark, sf_dir, "embeddings"), "vec_id", path, "embedding", min_parts=4)
    found = with_ordinal(scan_npy(spark, path, split_bytes=1 << 16), ["shard", "row_index"])
    return found.select("ordinal", F.posexplode("vector").alias("pos", "value"))


def neighbors_incremental(spark, sf_dir) -> DataFrame:
    """Shards arriving as files, folded into the running lists."""
    work = scratch_path(spark, "arriving")
    base = vectors(spark, sf_dir).select("pk", "vector")
    base.repartitionByRange(4, "pk").write.parquet(f"{work}/source")
    found = knn_incremental(
        spark, f"{work}/source", queries(spark, sf_dir), 10, "l2", f"{work}/state", files_per_step=2
    )
    return rounded(found, "distance")


SQL_STATS = """
    count(*) AS n, round(avg(value), 6) AS avg, round(sum(value), 6) AS sum,
    round(min(value), 6) AS min, round(max(value), 6) AS max,
    round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
    round(quantile_cont(value, 0.99), 6) AS p99
"""
SQL_GROUPED = f"SELECT shard_no // {SHARDS_PER_GROUP} AS grp, * FROM ({SQL_VECTORS})"
SQL_CHUNKS = f"""
    SELECT *, ord // {CHUNK_ROWS} AS chunk,
           ord % {CHUNK_ROWS} = 0 AS opens,
           ord % {CHUNK_ROWS} = {CHUNK_ROWS - 1} OR ord = max(ord) OVER (PARTITION BY grp) AS closes
    FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY shard_no, row_index) - 1 AS ord
          FROM ({SQL_GROUPED}))
"""
SQL_NUMBERS = f"SELECT DISTINCT shard_no AS n FROM ({SQL_VECTORS})"
SQL_LINKS = " UNION ALL ".join(
    f"SELECT n, printf('{LINK_BASE}{template}', n) AS url FROM ({SQL_NUMBERS})"
    for template in LINK_KINDS.values()
)
ANCHOR = r"""(?i)<a(?:\s[^>]*?)?\shref\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)"""
NO_TAGS = "(?is)<!--.*?-->|<(script|style|title|textarea)[^>]*>.*?</(script|style|title|textarea)>"
QUOTES = """^["'']|["'']$"""

SQL_SOME_PAGES = "page IN (last // 2, last // 2 + 1, last)"

QUERIES = {
    "scan_page_at": (
        pages_at,
        f"""SELECT event_id, user_id, event_type, ordinal, page
            FROM (SELECT *, ordinal // {PAGE_ROWS} AS page, max(ordinal) OVER () // {PAGE_ROWS} AS last
                  FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS ordinal FROM events WHERE event_id >= 0))
            WHERE {SQL_SOME_PAGES}""",
    ),
    "search_page_at": (
        found_pages_at,
        f"""SELECT rank, page, id, round(d, 6) AS distance
            FROM (SELECT *, (rank - 1) // {CHUNK_ROWS} AS page, (max(rank) OVER () - 1) // {CHUNK_ROWS} AS last
                  FROM (SELECT *, row_number() OVER (ORDER BY d DESC, id) AS rank
                        FROM (SELECT b.vec_id AS id, {sql_cosine("b.embedding", "q.embedding")} AS d
                              FROM embeddings b, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q)))
            WHERE {SQL_SOME_PAGES}""",
    ),
    "scan_pages": (
        paged_scan,
        f"""SELECT event_id, user_id, event_type, ordinal, ordinal // {PAGE_ROWS} AS page
            FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS ordinal
                  FROM events WHERE event_id >= 0)""",
    ),
    "search_pages": (
        paged_search,
        f"""SELECT rank, (rank - 1) // {CHUNK_ROWS} AS page, id, round(d, 6) AS distance
            FROM (SELECT *, row_number() OVER (ORDER BY d DESC, id) AS rank
                  FROM (SELECT b.vec_id AS id, {sql_cosine("b.embedding", "q.embedding")} AS d
                        FROM embeddings b,
                             (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q))""",
    ),
    "scan_pages_limited": (
        paged_scan_limited,
        """SELECT event_id, user_id, event_type, ordinal, ordinal // 7 AS page
           FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS ordinal FROM events WHERE event_id >= 5)
           WHERE ordinal < 40""",
    ),
    "search_pages_limited": (
        paged_search_limited,
        f"""SELECT rank, (rank - 1) // 7 AS page, id, round(d, 6) AS distance
            FROM (SELECT *, row_number() OVER (ORDER BY d DESC, id) AS rank
                  FROM (SELECT b.vec_id AS id, {sql_cosine("b.embedding", "q.embedding")} AS d
                        FROM embeddings b,
                             (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q))
            WHERE rank <= 40""",
    ),
    "shard_files": (
        shard_files,
        f"""SELECT n AS i, j, printf('passage_%02d-%d.parquet', n, j) AS path
            FROM ({SQL_NUMBERS}), (SELECT unnest([0, 1, 2])::BIGINT AS j) WHERE n >= 1""",
    ),
    "chunk_rows": (chunked, f"SELECT grp, shard_no, row_index, pk, ord, chunk FROM ({SQL_CHUNKS})"),
    "chunk_rows_ordered": (
        chunked_by_order,
        """SELECT source, doc_id, ord, ord // 40 AS chunk
           FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS ord FROM documents)""",
    ),
    "export_json_lines": (
        exported,
        f"""SELECT grp, chunk, opens, closes, pk, CAST(generate_subscripts(vector, 1) - 1 AS INTEGER) AS pos,
                   CAST(round(unnest(vector)::DOUBLE * 1e8) AS BIGINT) AS value_e8
            FROM ({SQL_CHUNKS})""",
    ),
    "latency_stats": (latency, f"SELECT event_type, {SQL_STATS} FROM events GROUP BY event_type"),
    "latency_first_n": (
        latency_prefix,
        f"""SELECT event_type, {SQL_STATS} FROM (
                SELECT * FROM events
                QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 150)
            GROUP BY event_type""",
    ),
    "latency_file": (
        latency_file,
        "SELECT row_number() OVER (ORDER BY event_id) - 1 AS seq, value AS cost_ms FROM events",
    ),
    "shard_paths": (
        named_shards,
        f"""SELECT n AS shard_no, part, printf('passage_%02d-%d.parquet', n, part) AS shard
            FROM ({SQL_NUMBERS}), (SELECT unnest([0, 1, 2, 3])::BIGINT AS part)""",
    ),
    "link_manifest": (links, f"SELECT url FROM ({SQL_LINKS})"),
    "extract_links": (
        page_links,
        f"""SELECT page_id, pos, replace(regexp_replace(raw, '{QUOTES}', '', 'g'), '&amp;', '&') AS href
            FROM (SELECT page_id, unnest(found) AS raw,
                         CAST(generate_subscripts(found, 1) - 1 AS INTEGER) AS pos
                  FROM (SELECT page_id, regexp_extract_all(regexp_replace(html, '{NO_TAGS}', '', 'g'), '{ANCHOR}', 1)
                                              AS found FROM pages))
            WHERE starts_with(href, '/')""",
    ),
    "shard_number": (
        numbers_in_names,
        rf"""SELECT url, split_part(url, '/', -1) AS file,
                    CAST(regexp_extract(url, '(\d+)\.\w+$', 1) AS INTEGER) AS number
             FROM ({SQL_LINKS})""",
    ),
    "vecs_roundtrip": (
        vec_files,
        """SELECT CAST(vec_id AS INTEGER) AS vec_id, label,
                  CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, unnest(embedding) AS value
           FROM embeddings""",
    ),
    "npy_roundtrip": (
        npy_files,
        """SELECT ordinal, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
                  unnest(embedding) AS value
           FROM (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS ordinal, embedding FROM embeddings)""",
    ),
    "knn_incremental": (neighbors_incremental, sql_neighbors("l2", 10)),
}
