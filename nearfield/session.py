"""Session helpers: local sessions for tests, and the shared folder lineage is cut into."""

from __future__ import annotations

import atexit
import os
import shutil
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

_fallback_root: dict[str, str] = {}
_made: list[str] = []


def local_session(app: str = "nearfield", cpus: int | str = "*") -> SparkSession:
    """A session for tests and benches; cluster jobs bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ship_with_tasks() -> None:
    """Send this package's code inside the pickled tasks.

    Executors then need no copy of it. Jobs that already pass it with ``--py-files`` can
    leave this out.
    """
    cloudpickle.register_pickle_by_value(sys.modules["nearfield"])


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or a temp one in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _fallback_root:
        _fallback_root[app] = tempfile.mkdtemp(prefix="nearfield-")
        atexit.register(shutil.rmtree, _fallback_root[app], ignore_errors=True)
    return _fallback_root[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    path = os.path.join(shared_root(spark), f"{name}-{uuid.uuid4().hex}")
    _made.append(path)
    return path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = hadoop.Path(path)
        at.getFileSystem(conf).delete(at, True)
        if path in _made:
            _made.remove(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table of this process; results that still read them become unusable.

    For the end of an application. The temporary folder of local sessions goes by itself.
    """
    discard(spark, *list(_made))


def cut_lineage(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder (to ``path`` if given) and read it back.

    Unlike a row checkpoint, later passes over the result still prune columns, and the
    table outlives lost executors.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
