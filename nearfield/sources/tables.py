"""Parquet and text tables: vectors, neighbours, latency series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield import schemas
from nearfield.functions.names import base_name, shard_number
from nearfield.operators.checks import enforce_schema
from nearfield.operators.ordinals import with_ordinal
from nearfield.sources.vecfiles import scan_npy_neighbors

ROWS_PER_FILE = 1_000_000


def scan_vectors(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Vector shards with ``shard`` (file name), ``shard_no`` and ``row_index``; columns pruned."""
    paths = [paths] if isinstance(paths, str) else paths
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*paths)
    return df.select(
        F.col("_metadata.file_name").alias("shard"),
        shard_number("_metadata.file_name").alias("shard_no"),
        F.col("_metadata.row_index").alias("row_index"),
        *(columns or [c for c in df.columns if c not in ("shard", "shard_no", "row_index")]),
    )


def list_shards(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``path, shard, shard_no, n_bytes`` of the files in a folder; nothing is opened."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return found.select(
        "path",
        base_name("path").alias("shard"),
        shard_number("path").alias("shard_no"),
        F.col("length").alias("n_bytes"),
    )


def write_vectors(
    df: DataFrame,
    dest: str,
    schema: T.StructType | None = None,
    shard: str = "shard_no",
    order: str = "pk",
    rows_per_file: int = ROWS_PER_FILE,
    clustered: bool = False,
) -> None:
    """One directory per shard, replaced whole on a re-run of that shard.

    A shard is written by as many tasks as it has ``rows_per_file`` blocks of keys. Rows that
    still lie as they were read, file by file, are ``clustered`` and are written without a
    shuffle.
    """
    if schema is not None:
        df = enforce_schema(
            df, T.StructType([f for f in schema.fields if f.name != shard] + [df.schema[shard]])
        )
    if not clustered:
        df = df.withColumn("_block", F.floor(F.col(order) / rows_per_file))
        df = df.repartition(shard, "_block").drop("_block")
    (
        df.sortWithinPartitions(shard, order)
        .write.partitionBy(shard)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(dest)
    )


def write_clustered(
    df: DataFrame, dest: str, by: list[str], key: str = "pk", rows_per_file: int = ROWS_PER_FILE, rows_per_group: int = 100_000
) -> None:
    """One table clustered by the attributes searches filter on, with Bloom filters on them.

    Rows lie in order of ``by`` and ``key``, so a predicate on ``by`` leaves most row groups unread by their
    least and greatest values, and an equality on a value that lies between those by the filter. A frequent value takes several files.
    """
    parts = max(1, -(-df.count() // rows_per_file))
    writer = df.repartitionByRange(parts, *by, key).sortWithinPartitions(*by, key).write.mode("overwrite")
    for column in by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(rows_per_group))
    writer.option("parquet.block.row.count.limit", rows_per_group).parquet(dest)


def scan_neighbors(spark: SparkSession, paths: str | list[str], fmt: str = "parquet") -> DataFrame:
    """Neighbour lists in long form, from Parquet or from structured ``.npy`` matrices."""
    paths = [paths] if isinstance(paths, str) else paths
    if fmt == "npy":
        return scan_npy_neighbors(spark, paths)
    return spark.read.parquet(*paths).select(schemas.NEIGHBORS.fieldNames())


def write_neighbors(
    df: DataFrame, dest: str, group: str | None = None, files_per_group: int = 4
) -> None:
    """Neighbour lists in long form; with ``group``, one directory per group, replaced whole.

    A group's rows are gathered by query into ``files_per_group`` files.
    """
    columns = schemas.NEIGHBORS.fieldNames()
    if group is None:
        df.select(columns).write.mode("overwrite").parquet(dest)
        return
    (
        df.select(group, *columns)
        .repartition(group, F.pmod(F.xxhash64("qid"), F.lit(files_per_group)))
        .write.partitionBy(group)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(dest)
    )


def scan_latency(spark: SparkSession, path: str) -> DataFrame:
    """One number per line, with its position in the file."""
    lines = (
        spark.read.schema("cost_ms double")
        .csv(path, mode="FAILFAST")
        .select(
            "cost_ms",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line"),
        )
    )
    return with_ordinal(lines, ["_file", "_block", "_line"], "seq").select("seq", "cost_ms")


def write_latency(df: DataFrame, dest: str) -> None:
    """One number per line in ``seq`` order over the numbered part files."""
    (
        df.repartitionByRange("seq")
        .sortWithinPartitions("seq")
        .select("cost_ms")
        .write.mode("overwrite")
        .csv(dest)
    )
