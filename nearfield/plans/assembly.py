"""Assembling keyed tables from shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield import schemas
from nearfield.operators.assembly import (
    assign_pk,
    audit_shards,
    count_mismatches,
    missing_shards,
    pending_shards,
    renumber_shards,
    shard_counts,
    zip_shards,
)
from nearfield.operators.checks import enforce_schema
from nearfield.operators.coread import zip_in_place
from nearfield.operators.ordinals import with_ordinal
from nearfield.plans.common import SQL_VECTORS, id_range, sharded, sql_sharded, table, vectors
from nearfield.session import scratch_path
from nearfield.sources.tables import scan_vectors, write_vectors
from nearfield.sources.vecfiles import PART_BYTES, current_folder, write_npy, write_shards
from nearfield.streaming.ingest import ingest_incremental

FILE_ROWS = 500  # rows of a vector or metadata file made for a positional join, and fewest of one made for an ingest
INGEST_FILES = 16  # files made for an ingest, until they reach ``PART_BYTES`` of vectors
GLOBAL_START = 1_229_565_156  # fixed value: first global key of a second dataset


def _documents(spark, sf_dir) -> DataFrame:
    """``documents`` in shards of the same layout as the vectors."""
    rows = sharded(table(spark, sf_dir, "documents"), "doc_id", id_range(spark, sf_dir))
    return rows.select("shard_no", "row_index", "doc_id", "lang", "source", "n_chars")


def keys(spark, sf_dir) -> DataFrame:
    rows = vectors(spark, sf_dir).select("shard_no", "row_index", F.col("pk").alias("vec_id"))
    return assign_pk(rows, start=1000, global_start=GLOBAL_START)


def keys_two_sources(spark, sf_dir) -> DataFrame:
    """Documents by source, then the benchmark, in one key space."""
    docs = table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("row_id"))
    items = table(spark, sf_dir, "benchmark").select(
        F.lit("zz_benchmark").alias("source"), F.col("item_id").alias("row_id")
    )
    return assign_pk(docs.unionByName(items), shard="source", row=None, order=["row_id"])


def zipped(spark, sf_dir) -> DataFrame:
    """Every vector with the document of its place; shards of unequal length would raise."""
    rows = vectors(spark, sf_dir)
    docs = _documents(spark, sf_dir)
    docs = docs.join(rows.select(F.col("pk").alias("doc_id")), "doc_id", "left_semi")
    rows = rows.join(docs.select(F.col("doc_id").alias("pk")), "pk", "left_semi")
    return zip_shards(docs, rows).select("shard_no", "row_index", "doc_id", "pk", "lang", "label")


def zipped_even(spark, sf_dir) -> DataFrame:
    """Only shards whose sides have the same length; documents from id 3 on, so one shard is short."""
    docs = _documents(spark, sf_dir).where("doc_id >= 3")
    pairs = zip_shards(docs, vectors(spark, sf_dir), on_mismatch="skip")
    return pairs.select("shard_no", "row_index", "doc_id", "pk", "lang", "label")


def uneven(spark, sf_dir) -> DataFrame:
    return count_mismatches(_documents(spark, sf_dir), vectors(spark, sf_dir))


def renumbered(spark, sf_dir) -> DataFrame:
    """From shard 2 on, numbered from 0, with fresh local and continued global keys."""
    rows = vectors(spark, sf_dir).select("shard_no", "row_index", F.col("pk").alias("vec_id"))
    moved = renumber_shards(rows, 2, 2**31 - 1)
    return assign_pk(moved, start=0, global_start=GLOBAL_START)


def missing(spark, sf_dir) -> DataFrame:
    expected = _documents(spark, sf_dir).select("shard_no").distinct()
    return missing_shards(expected, vectors(spark, sf_dir), "shard_no")


def audited(spark, sf_dir) -> DataFrame:
    """Expected shards that exist; missing ones are left out."""
    expected = _documents(spark, sf_dir).select("shard_no").distinct()
    return audit_shards(expected, vectors(spark, sf_dir), "skip", "shard_no")


def pending(spark, sf_dir) -> DataFrame:
    shards = shard_counts(_documents(spark, sf_dir)).select("shard_no", "n_rows")
    manifest = shard_counts(vectors(spark, sf_dir))
    return pending_shards(shards, manifest, "shard_no")


def typed(spark, sf_dir) -> DataFrame:
    """Reordered and cast to the bare vector layout."""
    rows = vectors(spark, sf_dir).select(
        "label", F.col("vector").cast("array<double>").alias("float32_vector"), F.col("pk").cast("string").alias("pk")
    )
    bare = enforce_schema(rows, schemas.BARE_VECTORS)
    return bare.select("pk", F.posexplode("float32_vector").alias("pos", "value"))


def scanned(spark, sf_dir) -> DataFrame:
    """File name and row position come with the scan."""
    found = scan_vectors(spark, f"{sf_dir}/embeddings.parquet", ["vec_id", "label"])
    return found.select("shard", "row_index", "vec_id", "label")


def stored(spark, sf_dir) -> DataFrame:
    """Written by shard and read back."""
    path = scratch_path(spark, "vectors")
    rows = vectors(spark, sf_dir).withColumnRenamed("vector", "float32_vector")
    write_vectors(rows.drop("label", "row_index"), path, schemas.BARE_VECTORS)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("shard_no").cast("long").alias("shard_no")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("pk").alias("first_pk"),
        F.max("pk").alias("last_pk"),
        F.round(F.sum(F.element_at("float32_vector", 1).cast("double")), 6).alias("first_elements"),
    )


def ingested(spark, sf_dir) -> DataFrame:
    """Vector files streamed in: keys follow file number, then row."""
    work = scratch_path(spark, "ingest")
    source = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    write_npy(source, "vec_id", f"{work}/source", min_parts=4)
    ingest_incremental(
        spark, current_folder(f"{work}/source"), f"{work}/dest", f"{work}/manifest",
        checkpoint=f"{work}/checkpoint", global_start=GLOBAL_START, shards_per_step=2,
    )
    back = spark.read.parquet(f"{work}/dest")
    return back.select("pk", "pk_5b", F.posexplode("float32_vector").alias("pos", "value")).withColumn(
        "value", F.round(F.col("value").cast("double"), 6)
    )


def _file_rows(spark, sf_dir) -> int:
    """Rows of a file made for an ingest: the files grow with the table, up to ``PART_BYTES`` of vectors."""
    size = table(spark, sf_dir, "embeddings").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    most = PART_BYTES // (4 * max(1, size.dim or 0))
    return max(FILE_ROWS, min(most, -(-size.n // INGEST_FILES)))


def _numbered(df: DataFrame, file_rows: int) -> DataFrame:
    """Rows in files of ``file_rows`` by id: as many files as the table asks for."""
    placed = with_ordinal(df, ["vec_id"], "_at")
    return placed.withColumn("file", F.floor(F.col("_at") / file_rows).cast("int")).drop("_at")


def _metadata(spark, sf_dir) -> DataFrame:
    """The eight metadata columns, made from the document of a vector's id."""
    docs = table(spark, sf_dir, "documents")
    return table(spark, sf_dir, "embeddings").join(docs, F.col("vec_id") == F.col("doc_id"), "left").select(
        "vec_id", F.substring("text", 1, 20).alias("caption"), F.col("lang").alias("NSFW"),
        (F.col("n_chars") / 8).alias("similarity"), F.col("n_chars").alias("width"),
        F.length("text").cast("long").alias("height"), F.col("doc_id").alias("original_width"),
        (F.col("doc_id") * 2).alias("original_height"), F.md5(F.col("text").cast("binary")).alias("md5"),
    )


def _ingested(spark, work: str, source: str, **options) -> DataFrame:
    ingest_incremental(
        spark, source, f"{work}/dest", f"{work}/manifest",
        checkpoint=f"{work}/checkpoint", global_start=GLOBAL_START, shards_per_step=2, **options,
    )
    rows = spark.read.parquet(f"{work}/dest").drop("shard_no")
    rest = [c for c in rows.columns if c != "float32_vector"]
    rows = rows.select(*rest, F.posexplode("float32_vector").alias("pos", "value"))
    return rows.withColumn("value", F.round(F.col("value").cast("double"), 6))


def _shard_pair(spark, sf_dir, work: str, file_rows: int = FILE_ROWS) -> tuple[str, str]:
    """Vector files and metadata files of the same numbers and rows; their folder and template."""
    vecs = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    write_shards(_numbered(vecs, file_rows), "file", "vec_id", f"{work}/source", template="emb_%04d.npy")
    meta = _numbered(_metadata(spark, sf_dir), file_rows)
    write_shards(meta, "file", "vec_id", f"{work}/meta", "parquet", "metadata_%04d.parquet")
    return current_folder(f"{work}/source"), f"{current_folder(f'{work}/meta')}/metadata_%04d.parquet"


def ingested_with_metadata(spark, sf_dir) -> DataFrame:
    """Row i of a metadata file beside row i of the vector file of its number, keyed and typed."""
    work = scratch_path(spark, "ingest")
    source, template = _shard_pair(spark, sf_dir, work, _file_rows(spark, sf_dir))
    return _ingested(spark, work, source, metadata_template=template)


def ingested_parquet(spark, sf_dir) -> DataFrame:
    """Parquet shards with keys of their own, keyed anew."""
    work = scratch_path(spark, "ingest")
    vecs = table(spark, sf_dir, "embeddings").select("vec_id", (F.col("vec_id") + 7).alias("pk"), F.col("embedding").alias("emb"))
    write_shards(_numbered(vecs, _file_rows(spark, sf_dir)), "file", "vec_id", f"{work}/source", "parquet", "emb_%04d.parquet")
    return _ingested(spark, work, current_folder(f"{work}/source"), fmt="parquet", vector_col="emb")


def zipped_in_place(spark, sf_dir) -> DataFrame:
    """Metadata rows, each beside the vector read from its place in the file of the same number."""
    work = scratch_path(spark, "zip")
    source, template = _shard_pair(spark, sf_dir, work)
    meta = scan_vectors(spark, template.rpartition("/")[0], ["vec_id", "NSFW", "height"])
    pairs = zip_in_place(meta.drop("shard"), f"{source}/emb_%04d.npy")
    return pairs.select("shard_no", "row_index", "vec_id", "NSFW", "height", F.posexplode("vector").alias("pos", "value")).withColumn(
        "value", F.round(F.col("value").cast("double"), 6)
    )


SQL_DOCUMENTS = sql_sharded("doc_id", "doc_id, lang, source, n_chars", "documents")
SQL_UNEVEN = f"""
    SELECT coalesce(m.shard_no, v.shard_no) AS shard_no, coalesce(m.n, 0) AS n_meta, coalesce(v.n, 0) AS n_vectors
    FROM (SELECT shard_no, count(*) AS n FROM ({SQL_DOCUMENTS}) GROUP BY 1) m
    FULL JOIN (SELECT shard_no, count(*) AS n FROM ({SQL_VECTORS}) GROUP BY 1) v ON m.shard_no = v.shard_no
    WHERE coalesce(m.n, 0) <> coalesce(v.n, 0)
"""

QUERIES = {
    "assign_pk": (
        keys,
        f"""SELECT shard_no, row_index, pk AS vec_id,
                   999 + row_number() OVER w AS pk, {GLOBAL_START - 1} + row_number() OVER w AS pk_global
            FROM ({SQL_VECTORS}) WINDOW w AS (ORDER BY shard_no, row_index)""",
    ),
    "assign_pk_two_sources": (
        keys_two_sources,
        """SELECT source, row_id, row_number() OVER (ORDER BY source, row_id) - 1 AS pk
           FROM (SELECT source, doc_id AS row_id FROM documents
                 UNION ALL SELECT 'zz_benchmark', item_id FROM benchmark)""",
    ),
    "positional_zip": (
        zipped,
        f"""SELECT m.shard_no, m.row_index, m.doc_id, v.pk, m.lang, v.label
            FROM ({SQL_DOCUMENTS}) m JOIN ({SQL_VECTORS}) v
              ON m.shard_no = v.shard_no AND m.row_index = v.row_index""",
    ),
    "zip_in_place": (
        zipped_in_place,
        f"""SELECT CAST(pos // {FILE_ROWS} AS INTEGER) AS shard_no, pos % {FILE_ROWS} AS row_index, vec_id, lang AS NSFW,
                   length(text) AS height, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
                   round(unnest(embedding)::DOUBLE, 6) AS value
            FROM (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS pos, * FROM embeddings)
            LEFT JOIN documents ON doc_id = vec_id""",
    ),
    "positional_zip_skip": (
        zipped_even,
        f"""WITH m AS (SELECT * FROM ({SQL_DOCUMENTS}) WHERE doc_id >= 3), v AS ({SQL_VECTORS}),
                 even AS (SELECT shard_no FROM (SELECT shard_no, count(*) AS n FROM m GROUP BY 1)
                          JOIN (SELECT shard_no, count(*) AS n FROM v GROUP BY 1) USING (shard_no, n))
            SELECT m.shard_no, m.row_index, m.doc_id, v.pk, m.lang, v.label
            FROM m JOIN v ON m.shard_no = v.shard_no AND m.row_index = v.row_index
            WHERE m.shard_no IN (SELECT shard_no FROM even)""",
    ),
    "zip_count_mismatch": (uneven, SQL_UNEVEN),
    "renumber_shards": (
        renumbered,
        f"""SELECT shard_no - 2 AS shard_no, row_index, pk AS vec_id,
                   row_number() OVER w - 1 AS pk, {GLOBAL_START - 1} + row_number() OVER w AS pk_global
            FROM ({SQL_VECTORS}) WHERE shard_no >= 2 WINDOW w AS (ORDER BY shard_no, row_index)""",
    ),
    "audit_missing_shards": (
        missing,
        f"""SELECT DISTINCT shard_no FROM ({SQL_DOCUMENTS})
            WHERE shard_no NOT IN (SELECT shard_no FROM ({SQL_VECTORS}))""",
    ),
    "audit_shards_skip": (
        audited,
        f"""SELECT DISTINCT shard_no FROM ({SQL_DOCUMENTS})
            WHERE shard_no IN (SELECT shard_no FROM ({SQL_VECTORS}))""",
    ),
    "resume_pending_shards": (
        pending,
        f"""SELECT shard_no, count(*) AS n_rows FROM ({SQL_DOCUMENTS})
            WHERE shard_no NOT IN (SELECT shard_no FROM ({SQL_VECTORS})) GROUP BY shard_no""",
    ),
    "schema_enforced": (
        typed,
        """SELECT vec_id AS pk, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
                  unnest(embedding) AS value FROM embeddings""",
    ),
    "scan_vectors": (
        scanned,
        """SELECT 'embeddings.parquet' AS shard, row_number() OVER (ORDER BY vec_id) - 1 AS row_index,
                  vec_id, label FROM embeddings""",
    ),
    "write_vectors": (
        stored,
        f"""SELECT shard_no, count(*) AS n_rows, min(pk) AS first_pk, max(pk) AS last_pk,
                   round(sum(vector[1]::DOUBLE), 6) AS first_elements
            FROM ({SQL_VECTORS}) GROUP BY shard_no""",
    ),
    "ingest_with_metadata": (
        ingested_with_metadata,
        f"""SELECT pk, pk + {GLOBAL_START} AS pk_5b, substr(text, 1, 20) AS caption, lang AS NSFW,
                   n_chars / 8 AS similarity, n_chars AS width, length(text) AS height,
                   doc_id AS original_width, doc_id * 2 AS original_height, md5(text) AS md5,
                   CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
                   round(unnest(embedding)::DOUBLE, 6) AS value
            FROM (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS pk, * FROM embeddings)
            LEFT JOIN documents ON doc_id = vec_id""",
    ),
    "ingest_parquet": (
        ingested_parquet,
        f"""SELECT pk, pk + {GLOBAL_START} AS pk_5b, vec_id,
                   CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
                   round(unnest(embedding)::DOUBLE, 6) AS value
            FROM (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS pk, vec_id, embedding FROM embeddings)""",
    ),
    "ingest_incremental": (
        ingested,
        f"""SELECT pk, pk + {GLOBAL_START} AS pk_5b,
                   CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
                   round(unnest(embedding)::DOUBLE, 6) AS value
            FROM (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS pk, embedding FROM embeddings)""",
    ),
}
