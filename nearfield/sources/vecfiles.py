"""Binary vector files as a Spark data source: ``.npy`` matrices, ``ivecs`` and ``fvecs``.

A file is read as many row ranges, each by its own task, and written as numbered part files
that concatenate to one valid ``ivecs``/``fvecs`` file.
"""

from __future__ import annotations

import json
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from nearfield.operators.ordinals import join_sized, with_ordinal

FORMAT = "vecfile"
SPLIT_BYTES = 64 << 20
OPEN_BYTES = 4 << 20  # what opening a file counts for when small ones share a task
ROWS_PER_BATCH = 4_096
PART_BYTES = 128 << 20
POINTER = "_current-"  # and a number: the file of the highest names the version that counts
COMMIT_THREADS = 16

SCHEMAS = {
    "npy": "shard string, row_index long, vector array<float>",
    "fvecs": "shard string, row_index long, vector array<float>",
    "ivecs": "shard string, row_index long, vector array<int>",
    "neighbors": "shard string, qid long, rank int, id long, distance double",
    "shape": "shard string, n_rows long, dim int",
}
SUFFIXES = {"ivecs": ".ivecs", "fvecs": ".fvecs", "parquet": ".parquet", "text": ".txt"}
FILE = "_file"  # column of the name of the file a row goes to
FIRST_ROW = re.compile(r"-r(\d+)\.npy$")  # a matrix part tells the row it begins at
NEIGHBOR = np.dtype([("idx", "<i8"), ("distance", "<f8")])
NO_ID = -1  # pads rows of a matrix beyond their list


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path for a URI or an absolute local path."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))


def _around(uri: str, path: str) -> tuple[str, str]:
    """What stands before and after ``path`` in ``uri``: scheme and authority, and query options."""
    base, mark, options = uri.partition("?") if "://" in uri else (uri, "", "")
    base, path = base.rstrip("/"), path.rstrip("/")
    if not base.endswith(path):
        raise ValueError(f"cannot tell the file system's part of {uri}")
    return base[: len(base) - len(path)], mark + options


def _versions(fs: pafs.FileSystem, root: str) -> list[tuple[int, str]]:
    """Number and version folder of every pointer in ``root``, the current one last."""
    out = []
    for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
        if f.base_name.startswith(POINTER):
            with fs.open_input_file(f.path) as data:
                out.append((int(f.base_name[len(POINTER):]), data.read().decode()))
    return sorted(out)


def current_folder(path: str) -> str:
    """The committed version of a folder of files; a folder without versions is its own."""
    fs, p = open_fs(path)
    versions = _versions(fs, p)
    before, after = _around(path, p)
    return f"{before}{p.rstrip('/')}/{versions[-1][1]}{after}" if versions else path


def list_files(paths: list[str], suffix: str) -> list[tuple[str, int]]:
    """Data files below the given files and directories with their sizes, in name order; none is opened.

    Of a directory written by this module only the committed version counts.
    """
    found = []
    for path in paths:
        fs, p = open_fs(path)
        before, after = _around(path, p)
        info = fs.get_file_info(p)
        if info.type == pafs.FileType.File:
            found.append((before + p + after, info.size))
            continue
        inside = [f for f in fs.get_file_info(pafs.FileSelector(p, recursive=True)) if f.type == pafs.FileType.File]
        roots = {f.path.rpartition("/")[0] for f in inside if f.base_name.startswith(POINTER)}
        current = {f"{root}/": f"{root}/{_versions(fs, root)[-1][1]}/" for root in roots}
        for f in sorted(inside, key=lambda f: f.path):
            if not f.base_name.endswith(suffix) or f.base_name.startswith(("_", ".")):
                continue
            if all(f.path.startswith(version) or not f.path.startswith(root) for root, version in current.items()):
                found.append((before + f.path + after, f.size))
    return found


def _base_name(uri: str) -> str:
    return (uri.partition("?")[0] if "://" in uri else uri).rsplit("/", 1)[-1]


@dataclass
class Pieces(InputPartition):
    """What a task reads: part ``i`` of ``n`` equal parts of each file's rows."""

    parts: list[tuple[str, int, int]]


@dataclass
class Matrix:
    """What a file's header says."""

    path: str
    data_start: int
    total: int
    dim: int
    dtype: np.dtype
    by_column: bool


def _npy_header(stream) -> tuple[tuple[int, ...], bool, np.dtype]:
    version = np.lib.format.read_magic(stream)
    read = {
        (1, 0): np.lib.format.read_array_header_1_0,
        (2, 0): np.lib.format.read_array_header_2_0,
    }.get(version)
    if read is None:
        raise ValueError(f"unsupported .npy version {version}")
    return read(stream)


def open_matrix(kind: str, path: str, f) -> Matrix:
    """Read the header of an open file."""
    if kind in ("ivecs", "fvecs"):
        size = f.size()
        dim = int(np.frombuffer(f.read(4), "<i4")[0]) if size else 0
        if dim < 0 or size % (4 * (dim + 1)):
            raise ValueError(f"{path}: size does not fit records of dimension {dim}")
        return Matrix(path, 0, size // (4 * (dim + 1)), dim, np.dtype("<i4"), False)
    shape, by_column, dtype = _npy_header(f)
    if len(shape) != 2 or dtype.hasobject:
        raise ValueError(f"{path}: not a plain 2-D matrix")
    return Matrix(path, f.tell(), *shape, dtype, by_column)


def read_rows(kind: str, f, m: Matrix, first: int, rows: int) -> np.ndarray:
    """Rows ``first`` to ``first + rows`` of an open file, read as one range (one a column if stored by column)."""
    if kind in ("ivecs", "fvecs"):
        width = m.dim + 1
        f.seek(4 * width * first)
        records = np.frombuffer(f.read(4 * width * rows), "<i4").reshape(rows, width)
        if (records[:, 0] != m.dim).any():
            raise ValueError(f"{m.path}: records of different dimensions")
        return records[:, 1:].copy()
    size = m.dtype.itemsize
    if not m.by_column:
        f.seek(m.data_start + size * m.dim * first)
        return np.frombuffer(f.read(size * m.dim * rows), m.dtype).reshape(rows, m.dim)
    out = np.empty((rows, m.dim), m.dtype)
    for j in range(m.dim):
        f.seek(m.data_start + size * (j * m.total + first))
        out[:, j] = np.frombuffer(f.read(size * rows), m.dtype)
    return out


def plan_pieces(files: list[tuple[str, int]], split_bytes: int) -> list[Pieces]:
    """Cut large files into equal parts and let small ones share a task, by size alone."""
    out, held, size = [], [], 0
    opening = min(OPEN_BYTES, split_bytes)
    for path, n_bytes in files:
        n = -(-n_bytes // split_bytes)
        if n > 1:
            out += [Pieces([(path, i, n)]) for i in range(n)]
            continue
        if held and size + n_bytes + opening > split_bytes:
            out.append(Pieces(held))
            held, size = [], 0
        held, size = [*held, (path, 0, 1)], size + n_bytes + opening
    return out + [Pieces(held)] * bool(held)


class VecFileReader(DataSourceReader):
    """Plans from listed sizes; headers are read by the tasks."""

    def __init__(self, kind: str, paths: list[str], split_bytes: int):
        self.kind, self.paths, self.split_bytes = kind, paths, split_bytes

    def partitions(self) -> list[InputPartition]:
        files = list_files(self.paths, SUFFIXES.get(self.kind, ".npy"))
        if self.kind == "shape":
            files = [(path, 0) for path, _ in files]
        return plan_pieces(files, self.split_bytes) or [Pieces([])]

    def read(self, part: Pieces):
        for path, i, n in part.parts:
            fs, p = open_fs(path)
            shard = _base_name(path)
            with fs.open_input_file(p) as f:
                m = open_matrix(self.kind, path, f)
                if self.kind == "shape":
                    yield (shard, m.total, m.dim)
                    continue
                first, end = m.total * i // n, m.total * (i + 1) // n
                for at in range(first, end, ROWS_PER_BATCH):
                    rows = min(ROWS_PER_BATCH, end - at)
                    yield self._batch(shard, at, read_rows(self.kind, f, m, at, rows))

    def _batch(self, shard: str, first: int, m: np.ndarray) -> pa.RecordBatch:
        rows, dim = m.shape
        if self.kind == "neighbors":
            id_name, distance_name = m.dtype.names
            first += int(found[1]) if (found := FIRST_ROW.search(shard)) else 0
            ids = m[id_name].astype(np.int64).ravel()
            there = ids != NO_ID
            columns = {
                "shard": pa.array([shard] * int(there.sum()), pa.string()),
                "qid": pa.array(np.repeat(np.arange(first, first + rows, dtype=np.int64), dim)[there]),
                "rank": pa.array(np.tile(np.arange(1, dim + 1, dtype=np.int32), rows)[there]),
                "id": pa.array(ids[there]),
                "distance": pa.array(m[distance_name].astype(np.float64).ravel()[there]),
            }
            return pa.RecordBatch.from_pydict(columns)
        if self.kind == "fvecs":
            m = m.view("<f4")
        flat = np.ascontiguousarray(m, dtype=np.int32 if self.kind == "ivecs" else np.float32).ravel()
        edges = np.arange(0, (rows + 1) * dim, dim, dtype=np.int32) if dim else np.zeros(rows + 1, np.int32)
        columns = {
            "shard": pa.array([shard] * rows, pa.string()),
            "row_index": pa.array(np.arange(first, first + rows, dtype=np.int64)),
            "vector": pa.ListArray.from_arrays(pa.array(edges), pa.array(flat)),
        }
        return pa.RecordBatch.from_pydict(columns)


class _Npy:
    """A float matrix; its header needs the row count, so its rows are held. Parts are sized by the caller."""

    kind, dim = "npy", None

    def __init__(self, fs, path: str):
        self.fs, self.path, self.rows, self.kept = fs, path, 0, []

    def add(self, batch: pa.RecordBatch) -> None:
        m = _plain(batch.column("vector"), "<i4" if self.kind == "ivecs" else "<f4")
        if self.dim is not None and m.shape[1] != self.dim:
            raise ValueError(f"vectors of dimension {self.dim} and {m.shape[1]}")
        self.dim, self.rows = m.shape[1], self.rows + len(m)
        self.put(m)

    def put(self, m: np.ndarray) -> None:
        self.kept.append(m)

    def close(self) -> None:
        with self.fs.open_output_stream(self.path) as out:
            np.lib.format.write_array(out, np.concatenate(self.kept), allow_pickle=False)


class _Vecs(_Npy):
    """Records of a dimension and its values, written as they come."""

    def __init__(self, fs, path: str):
        super().__init__(fs, path)
        self.out = fs.open_output_stream(path)

    def put(self, m: np.ndarray) -> None:
        records = np.empty((len(m), self.dim + 1), "<i4")
        records[:, 0], records[:, 1:] = self.dim, m.view("<i4")
        self.out.write(records.tobytes())

    def close(self) -> None:
        self.out.close()


class _IdVecs(_Vecs):
    kind = "ivecs"


class _Neighbors(_Npy):
    """Rows of (id, distance) pairs at their places; ``row`` counts from the row in the file's name."""

    def __init__(self, fs, path: str):
        super().__init__(fs, path)
        self.places = []

    def add(self, batch: pa.RecordBatch) -> None:
        ids, distances = (_plain(batch.column(c), kind) for c, kind in (("ids", "<i8"), ("distances", "<f8")))
        self.dim = ids.shape[1]
        m = np.empty(ids.shape, NEIGHBOR)
        m["idx"], m["distance"] = ids, distances
        self.kept.append(m)
        self.places.append(batch.column("row").to_numpy())

    def close(self) -> None:
        places = np.concatenate(self.places)
        if len(np.unique(places)) != len(places):
            raise ValueError(f"{self.path}: two lists for one row")
        self.rows = int(places.max()) + 1
        out = np.empty((self.rows, self.dim), NEIGHBOR)
        out["idx"], out["distance"] = NO_ID, np.inf  # rows without a list
        out[places] = np.concatenate(self.kept)
        self.kept = [out]
        super().close()


class _Parquet:
    """Rows as they come, in row groups of a batch or more."""

    dim = None

    def __init__(self, fs, path: str):
        self.fs, self.path, self.rows, self.out = fs, path, 0, None

    def add(self, batch: pa.RecordBatch) -> None:
        batch = batch.drop_columns([FILE])
        self.out = self.out or pq.ParquetWriter(self.path, batch.schema, filesystem=self.fs)
        self.out.write_batch(batch)
        self.rows += batch.num_rows

    def close(self) -> None:
        self.out.close()


class _Text:
    """Lines as they come."""

    dim = None

    def __init__(self, fs, path: str):
        self.path, self.rows, self.out = path, 0, fs.open_output_stream(path)

    def add(self, batch: pa.RecordBatch) -> None:
        lines = batch.column("value").to_pylist()
        self.out.write("".join(f"{line}\n" for line in lines).encode())
        self.rows += len(lines)

    def close(self) -> None:
        self.out.close()


WRITERS = {"text": _Text, "npy": _Npy, "fvecs": _Vecs, "ivecs": _IdVecs, "neighbors": _Neighbors, "parquet": _Parquet}


def _plain(col: pa.Array, kind: str) -> np.ndarray:
    values = col.flatten()
    widths = np.diff(col.offsets.to_numpy())
    if col.null_count or values.null_count or (widths != widths[0]).any():
        raise ValueError("NULL or ragged vectors cannot be written")
    return np.ascontiguousarray(values.to_numpy(zero_copy_only=False).reshape(len(col), widths[0]), kind)


@dataclass
class FilesWritten(WriterCommitMessage):
    files: list[tuple[str, str, int | None]]  # temporary name, name, dimension


class VecFileWriter(DataSourceArrowWriter):
    """A job writes a version of the folder of its own; the commit names its files and then switches the
    pointer to it, in one write. Until then readers see the old version, which is kept for those under way.

    Tasks write one file per run of equal names in the column ``_file`` (null: one named after the task). A name may
    begin with a subfolder.
    """

    def __init__(self, kind: str, dest: str):
        self.kind, self.dest = kind, dest
        self.folder = f"version-{uuid.uuid4().hex}"

    def write(self, iterator) -> FilesWritten:
        context = TaskContext.get()
        fs, root = open_fs(self.dest)
        fs.create_dir(f"{root}/{self.folder}", recursive=True)
        own = f"part-{context.partitionId():06d}" + SUFFIXES.get(self.kind, ".npy")
        files, name, out = [], None, None

        def close() -> None:
            if out is not None:
                out.close()
                files.append((out.path, name, out.dim))

        for batch in iterator:
            if not batch.num_rows:
                continue
            names = batch.column(FILE).fill_null(own)
            runs = pc.run_end_encode(names)
            at = 0
            for end, value in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()):
                if value != name:
                    close()
                    name = value
                    temp = f"{root}/{self.folder}/.{name.replace('/', '-')}-{context.taskAttemptId()}"
                    out = WRITERS[self.kind](fs, temp)
                out.add(batch.slice(at, end - at))
                at = end
        close()
        return FilesWritten(files)

    def commit(self, messages) -> None:
        files = [f for m in messages if m for f in m.files]
        try:
            if len({name for _, name, _ in files}) != len(files):
                raise ValueError("a file's rows lie in two tasks")
            dims = sorted({dim for _, _, dim in files if dim is not None})
            if len(dims) > 1:  # parts concatenate to one file, so they must agree
                raise ValueError(f"vectors of dimension {dims[0]} and {dims[-1]}")
        except ValueError:
            self.abort(messages)
            raise
        fs, root = open_fs(self.dest)
        for folder in {name.rpartition("/")[0] for _, name, _ in files} | {""}:
            fs.create_dir(f"{root}/{self.folder}/{folder}".rstrip("/"), recursive=True)
        with ThreadPoolExecutor(COMMIT_THREADS) as pool:
            list(pool.map(lambda f: fs.move(f[0], f"{root}/{self.folder}/{f[1]}"), files))
        old = _versions(fs, root)
        number = old[-1][0] + 1 if old else 0
        temp = f"{root}/.{self.folder}"
        with fs.open_output_stream(temp) as out:
            out.write(self.folder.encode())
        fs.move(temp, f"{root}/{POINTER}{number:010d}")  # the commit: one rename to a new name
        kept = {self.folder, *(folder for _, folder in old[-1:])}
        for f in fs.get_file_info(pafs.FileSelector(root)):
            if f.base_name.startswith("version-") and f.base_name not in kept:
                fs.delete_dir(f.path)
            elif f.base_name.startswith(POINTER) and int(f.base_name[len(POINTER):]) < number - 1:
                fs.delete_file(f.path)

    def abort(self, messages) -> None:
        fs, root = open_fs(self.dest)
        if fs.get_file_info(f"{root}/{self.folder}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{self.folder}")


class VecFileSource(DataSource):
    """Options: ``kind`` (npy, neighbors, ivecs, fvecs; parquet and text for writing), ``paths`` (JSON list) or ``dest``, ``split_bytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _kind(self) -> str:
        kind = self.options.get("kind", "npy")
        if kind not in SCHEMAS and kind not in WRITERS:
            raise ValueError(f"unknown vector file kind {kind!r}")
        return kind

    def schema(self) -> str:
        return SCHEMAS.get(self._kind(), f"{FILE} string")

    def reader(self, schema) -> VecFileReader:
        paths = json.loads(self.options["paths"])
        return VecFileReader(self._kind(), paths, int(self.options.get("split_bytes", SPLIT_BYTES)))

    def writer(self, schema, overwrite: bool) -> VecFileWriter:
        if not overwrite:
            raise ValueError("vector files are replaced whole: use mode overwrite")
        return VecFileWriter(self._kind(), self.options["dest"])


def _scan(spark: SparkSession, kind: str, path: str | list[str], split_bytes: int) -> DataFrame:
    spark.dataSource.register(VecFileSource)
    paths = [path] if isinstance(path, str) else path
    return (
        spark.read.format(FORMAT)
        .option("kind", kind)
        .option("paths", json.dumps(paths))
        .option("split_bytes", split_bytes)
        .load()
    )


def scan_npy(spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``shard, row_index, vector`` of 2-D matrices of any numeric type, as float32."""
    return _scan(spark, "npy", path, split_bytes)


def with_position(rows: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Add ``position``: the row's place in all parts (``shard``, ``row_index``) of a set together.

    Only the parts' sizes are summed, no row is sorted. ``sizes`` (``shard``, ``n_rows``) saves counting.
    """
    if sizes is None:
        sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"))
    starts = with_ordinal(sizes.select("shard", "n_rows"), ["shard"], "start", weight="n_rows")
    placed = join_sized(rows, starts.select("shard", "start"), ["shard"])
    return placed.withColumn("position", F.col("start") + F.col("row_index")).drop("start")


def scan_npy_set(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``qid, vector`` of a matrix written in one or more parts; sizes come from the headers."""
    rows = with_position(scan_npy(spark, path), npy_shapes(spark, path))
    return rows.select(F.col("position").alias("qid"), "vector")


def npy_shapes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``shard, n_rows, dim`` from the file headers alone."""
    return _scan(spark, "shape", path, SPLIT_BYTES)


def scan_vecs(
    spark: SparkSession, path: str | list[str], kind: str = "ivecs", split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    if kind not in ("ivecs", "fvecs"):
        raise ValueError("kind must be 'ivecs' or 'fvecs'")
    return _scan(spark, kind, path, split_bytes)


def scan_npy_neighbors(
    spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Partial results saved as ``[queries, k]`` matrices of (id, distance) pairs; qid is the row."""
    return _scan(spark, "neighbors", path, split_bytes).drop("shard")


def _write(df: DataFrame, kind: str, dest: str) -> None:
    df.sparkSession.dataSource.register(VecFileSource)
    if FILE not in df.columns:
        df = df.withColumn(FILE, F.lit(None).cast("string"))
    df.write.format(FORMAT).option("kind", kind).option("dest", dest).mode("overwrite").save()


def write_vecs(
    df: DataFrame, order: str | Column, dest: str, kind: str = "ivecs", vector: str = "vector",
    partitions: int | None = None,
) -> None:
    """Write lists in ``order``; ids outside the 32-bit range are an error in ``ivecs``."""
    if kind not in ("ivecs", "fvecs"):
        raise ValueError("kind must be 'ivecs' or 'fvecs'")
    v = F.col(vector)
    if kind == "ivecs":
        v = F.transform(
            v,
            lambda x: F.when(
                (x > 2147483647) | (x < -2147483648),
                F.raise_error(F.concat(F.lit("id does not fit 32 bits: "), x.cast("string"))).cast("int"),
            ).otherwise(x.cast("int")),
        )
    else:
        v = v.cast("array<float>")
    key = F.col(order) if isinstance(order, str) else order
    rows = df.select(key.alias("_key"), v.alias("vector"))
    ranged = rows.repartitionByRange(*([partitions] if partitions else []), "_key")
    _write(ranged.sortWithinPartitions("_key").select("vector"), kind, dest)


def write_npy(
    df: DataFrame, order: str | Column, dest: str, vector: str = "vector", min_parts: int = 1
) -> None:
    """Write a float32 matrix in ``order``: one part while it is small, else parts of about ``PART_BYTES``."""
    size = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("dim")).first()
    parts = max(min_parts, -(-size.n * 4 * (size.dim or 0) // PART_BYTES))
    key = F.col(order) if isinstance(order, str) else order
    rows = df.select(key.alias("_key"), F.col(vector).cast("array<float>").alias("vector"))
    ranged = rows.repartitionByRange(parts, "_key").sortWithinPartitions("_key")
    _write(ranged.select("vector"), "npy", dest)


def write_shards(
    df: DataFrame, shard: str, order: str, dest: str, kind: str = "npy", template: str = "part-%06d.npy"
) -> None:
    """One file per shard number, named by ``template``, with the shard's rows in ``order``.

    ``npy`` files take the column ``vector`` and are held by the writing task, so shards are to be cut to size; ``parquet``
    files stream all columns but ``shard``.
    """
    name = F.format_string(template, F.col(shard))
    rows = df.withColumn("vector", F.col("vector").cast("array<float>")).select(shard, order, "vector") if kind == "npy" else df
    rows = rows.withColumn(FILE, name).repartition(shard).sortWithinPartitions(shard, order)
    _write(rows.select(FILE, "vector") if kind == "npy" else rows.drop(shard), kind, dest)


def write_npy_neighbors(
    neighbors: DataFrame, dest: str, k: int, group: str | None = None, part_bytes: int = PART_BYTES
) -> None:
    """Neighbour lists in long form as ``[queries, k]`` matrices of (id, distance) pairs; row i belongs to query i.

    A group (a shard number) has a matrix of its own, in parts of about ``part_bytes`` that begin at
    the row in their name. Lists shorter than ``k`` and queries without one are padded with id -1. Query ids count from 0.
    """
    rows = max(1, part_bytes // (NEIGHBOR.itemsize * k))
    number = F.col(group).cast("long") if group else F.lit(0).cast("long")
    wrong = F.raise_error(F.concat(F.lit("cannot be a row of a matrix: query, rank or id "), F.concat_ws(", ", "qid", "rank", "id")))
    fits = (F.col("qid") >= 0) & F.col("rank").between(1, k) & (F.col("id") >= 0)
    lists = (
        neighbors.select(number.alias("number"), "qid", F.when(fits, F.col("rank")).otherwise(wrong.cast("int")).alias("rank"), "id", "distance")
        .groupBy("number", "qid")
        .agg(F.map_from_entries(F.collect_list(F.struct("rank", F.struct("id", "distance")))).alias("hits"))
        .withColumn("first", F.floor(F.col("qid") / rows).cast("long") * rows)
    )
    places = F.sequence(F.lit(1), F.lit(k))

    def column(field: str, missing) -> Column:
        return F.transform(places, lambda r: F.coalesce(F.try_element_at("hits", r)[field], F.lit(missing)))

    lists = lists.select(
        F.format_string("part-%06d-r%012d.npy", "number", "first").alias(FILE),
        (F.col("qid") - F.col("first")).alias("row"),
        column("id", NO_ID).cast("array<long>").alias("ids"),
        column("distance", float("inf")).cast("array<double>").alias("distances"),
    )
    _write(lists.repartition(FILE).sortWithinPartitions(FILE, "row"), "neighbors", dest)


def write_text_files(df: DataFrame, file: Column, order: list[str], dest: str, value: str = "value") -> None:
    """One text file per name ``file`` with its lines in ``order``; a name may begin with a subfolder."""
    rows = df.select(file.alias(FILE), *order, F.col(value).alias("value"))
    rows = rows.repartition(FILE).sortWithinPartitions(FILE, *order)
    _write(rows.select(FILE, "value"), "text", dest)
