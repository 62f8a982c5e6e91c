"""Resumable assembly of a keyed vector table from arriving shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield import schemas
from nearfield.functions.names import shard_number
from nearfield.operators.assembly import assign_pk, pending_shards, zip_shards
from nearfield.operators.checks import checked_vector
from nearfield.sources.tables import list_shards, scan_vectors, write_vectors
from nearfield.sources.vecfiles import current_folder, npy_shapes, scan_npy
from nearfield.streaming.shards import stream_shards

SHARDS_PER_STEP = 1_000


def new_shards(shards: DataFrame, manifest: DataFrame) -> list:
    """The batch's unprocessed shards in number order; a batch has at most ``shards_per_step`` of them."""
    return pending_shards(shards, manifest).orderBy("shard_no", "shard").collect()


def check_late(spark: SparkSession, source_dir: str, suffix: str, manifest: DataFrame, last: int) -> None:
    """Raise if a file of a number up to ``last`` is not in the manifest: its keys are taken."""
    late = pending_shards(list_shards(spark, source_dir, f"*{suffix}").where(F.col("shard_no") <= last), manifest)
    if (first := late.orderBy("shard_no", "shard").first()) is not None:
        raise ValueError(f"shard {first.shard_no} arrived after shard {last}")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(schemas.MANIFEST).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schemas.MANIFEST)


def ingest_incremental(
    spark: SparkSession,
    source_dir: str,
    dest: str,
    manifest: str,
    *,
    checkpoint: str | None = None,
    global_start: int = 0,
    metadata_template: str | None = None,
    fmt: str = "npy",
    vector_col: str = "vector",
    shards_per_step: int = SHARDS_PER_STEP,
) -> DataFrame:
    """Ingest every shard not in the manifest yet, then stop; returns the manifest.

    Keys continue where the manifest ends. Shards come in number order, ``shards_per_step`` a batch: the stream's
    offsets are shard numbers. A batch writes the shards (each replaced whole), then their manifest rows, so a
    crash in between repeats the same shards with the same keys. Vector files are read once, their sizes come from the headers.
    ``metadata_template`` (e.g. ``'/meta/metadata_%04d.parquet'``) adds row i of the metadata
    file of the same number to vector i. There is one writer per manifest.
    """
    suffix = ".npy" if fmt == "npy" else ".parquet"

    def process(shards: DataFrame, epoch: int) -> None:
        session = shards.sparkSession
        # Batches come in number order: behind one that ingested shards, none can be in the manifest.
        known = session.createDataFrame([], schemas.MANIFEST) if reached["beyond"] else read_manifest(session, manifest)
        todo = new_shards(shards, known)
        for one, other in zip(todo, todo[1:]):  # in number order
            if one.shard_no == other.shard_no:
                raise ValueError(f"{one.shard} and {other.shard} have the same shard number")
        if todo:
            step(session, todo)

    def step(session: SparkSession, todo: list) -> None:
        if reached["no"] is not None and todo[0].shard_no <= reached["no"]:
            raise ValueError(f"shard {todo[0].shard_no} arrived after shard {reached['no']}")
        files = [s.path for s in todo]
        sizes = None
        if fmt == "npy":
            rows = scan_npy(session, files).withColumn("shard_no", shard_number("shard"))
            shapes = npy_shapes(session, files).withColumn("shard_no", shard_number("shard"))
            dims = shapes.where("n_rows > 0").agg(F.min("dim"), F.max("dim")).first()
            if dims[0] != dims[1]:
                raise ValueError(f"vector files of dimensions {dims[0]} to {dims[1]}")
            rows = rows.withColumn("vector", checked_vector("vector", dims[0] or 0))
            sizes = shapes.where("n_rows > 0").select("shard_no", "n_rows")
        else:
            rows = scan_vectors(session, files).withColumnRenamed(vector_col, "vector")
            head = rows.where("vector IS NOT NULL").select(F.size("vector")).first()
            rows = rows.withColumn("vector", checked_vector("vector", head[0] if head else 0))
        rows = rows.drop("shard", "pk", "pk_5b")
        if metadata_template is not None:
            meta = scan_vectors(
                session,
                [metadata_template % s.shard_no for s in todo],
                schemas.METADATA.fieldNames(),
            )
            rows = zip_shards(meta.drop("shard"), rows, vector_sizes=sizes)
        keyed = assign_pk(
            rows, start=reached["next"], global_start=reached["next"] + global_start, sizes=sizes
        )
        table = keyed.withColumnsRenamed({"pk_global": "pk_5b", "vector": "float32_vector"})
        table = table.withColumn("float32_vector", F.col("float32_vector").cast("array<float>"))
        full = set(schemas.FULL_VECTORS.fieldNames()) <= set(table.columns)
        write_vectors(
            table.drop("row_index"), dest, schemas.FULL_VECTORS if full else None,
            clustered=metadata_template is None,
        )
        # Counted from what was written, so keys and manifest cannot disagree.
        written = _key_ranges(_written(session, dest, todo), [s.shard_no for s in todo])
        names = session.createDataFrame(
            [(s.shard, s.shard_no) for s in todo], "shard string, shard_no int"
        )
        records = names.join(written, "shard_no", "left").select(
            "shard", "shard_no", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            "pk_start", "pk_global_start", F.lit("done").alias("status"),
        )
        found = records.collect()  # a row for each shard of the step
        session.createDataFrame(found, records.schema).coalesce(1).write.mode("append").parquet(manifest)
        ends = [r.pk_start + r.n_rows for r in found if r.pk_start is not None]
        reached.update(no=todo[-1].shard_no, next=max(ends, default=reached["next"]), beyond=True)

    source = current_folder(source_dir)
    done = read_manifest(spark, manifest)
    last, after = done.agg(F.max("shard_no"), F.coalesce(F.max(F.col("pk_start") + F.col("n_rows")), F.lit(0))).first()
    # What the manifest says is read once a call and carried on, so a step costs the same however many came before.
    reached = {"no": last, "next": after, "beyond": False}
    if last is not None:
        check_late(spark, source, suffix, done, last)
    query = (
        stream_shards(spark, source, suffix, -1 if last is None else last, shards_per_step)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint or f"{manifest.rstrip('/')}-checkpoint")
        .start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return read_manifest(spark, manifest)


def _written(spark: SparkSession, dest: str, todo: list) -> DataFrame:
    """This step's shards: only their directories are listed. A shard without rows has none."""
    paths = [f"{dest.rstrip('/')}/shard_no={s.shard_no}" for s in todo]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    there = [p for p in paths if (at := hadoop.Path(p)).getFileSystem(conf).exists(at)]
    if not there:
        return spark.createDataFrame([], "shard_no int, pk long, pk_5b long")
    return spark.read.option("basePath", dest).parquet(*there)


def _key_ranges(table: DataFrame, shard_nos: list[int]) -> DataFrame:
    return (
        table.where(F.col("shard_no").isin(shard_nos))
        .groupBy("shard_no")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("pk").alias("pk_start"),
            F.min("pk_5b").alias("pk_global_start"),
        )
    )
