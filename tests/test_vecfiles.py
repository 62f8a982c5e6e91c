from pathlib import Path

import numpy as np
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import pytest
from conftest import vector_frame
from pyspark.sql import functions as F

from nearfield.functions.names import shard_number
from nearfield.operators.topk import merge_topk
from nearfield.sources.tables import scan_neighbors, write_neighbors
from nearfield.sources import vecfiles
from nearfield.sources.vecfiles import (
    VecFileReader,
    VecFileWriter,
    _around,
    current_folder,
    list_files,
    npy_shapes,
    plan_pieces,
    scan_npy,
    scan_npy_neighbors,
    scan_npy_set,
    scan_vecs,
    write_npy,
    write_npy_neighbors,
    write_shards,
    write_vecs,
)


def matrix(df):
    rows = df.orderBy("shard", "row_index").collect()
    return np.array([r.vector for r in rows])


@pytest.mark.parametrize("dtype", ["float16", "float32", "float64", "int8", ">f4"])
@pytest.mark.parametrize("by_column", [False, True])
def test_scan_npy(spark, tmp_path, rng, dtype, by_column):
    parts = [(rng.normal(size=(n, 6)) * 9).astype(dtype) for n in (130, 1, 77)]
    for i, m in enumerate(parts):
        np.save(tmp_path / f"emb_{i:04d}.npy", np.asfortranarray(m) if by_column else m)
    largest = (tmp_path / "emb_0000.npy").stat().st_size
    df = scan_npy(spark, str(tmp_path), split_bytes=-(-largest // 3))
    assert df.rdd.getNumPartitions() >= 3 + 1 + 1
    np.testing.assert_array_equal(matrix(df), np.concatenate(parts).astype(np.float32))
    assert df.schema.simpleString() == "struct<shard:string,row_index:bigint,vector:array<float>>"


def test_scan_npy_rejects_other_shapes(spark, tmp_path):
    np.save(tmp_path / "a.npy", np.zeros(5))
    with pytest.raises(Exception, match="2-D"):
        scan_npy(spark, str(tmp_path)).collect()


def bytes_of(path, suffix):
    return b"".join(p.read_bytes() for p in sorted(path.glob(f"*.{suffix}")))


@pytest.mark.parametrize("kind", ["ivecs", "fvecs"])
def test_vecs_round_trip(spark, tmp_path, rng, kind):
    if kind == "ivecs":
        m = rng.integers(-(2**31), 2**31 - 1, size=(120, 5)).astype(np.int32)
        df = spark.createDataFrame([(i, [int(x) for x in v]) for i, v in enumerate(m)], "k long, vector array<long>")
    else:
        m = rng.normal(size=(120, 5)).astype(np.float32)
        df = vector_frame(spark, range(120), m, "k")
    dest = tmp_path / "out"
    write_vecs(df.repartition(7), "k", str(dest), kind, partitions=3)
    records = np.empty((120, 6), "<i4")
    records[:, 0], records[:, 1:] = 5, m.view("<i4")
    version = Path(current_folder(str(dest)))
    assert len(list(version.glob(f"part-*.{kind}"))) == 3
    assert bytes_of(version, kind) == records.tobytes()
    np.testing.assert_array_equal(matrix(scan_vecs(spark, str(dest), kind, split_bytes=100)), m)
    # A rewrite leaves no old part behind.
    write_vecs(df.where("k < 4"), "k", str(dest), kind, partitions=1)
    assert matrix(scan_vecs(spark, str(dest), kind)).shape == (4, 5)


def test_ivecs_range_and_shape_checks(spark, tmp_path):
    big = spark.createDataFrame([(0, [2**31])], "k long, vector array<long>")
    with pytest.raises(Exception, match="does not fit 32 bits"):
        write_vecs(big, "k", str(tmp_path / "a"), "ivecs")
    ragged = spark.createDataFrame([(0, [1]), (1, [1, 2])], "k long, vector array<long>")
    with pytest.raises(Exception, match="dimension|ragged"):
        write_vecs(ragged, "k", str(tmp_path / "b"), "ivecs", partitions=1)
    assert not list((tmp_path / "b").rglob("*.ivecs"))
    (tmp_path / "c.ivecs").write_bytes(np.array([2, 1, 1, 1], "<i4").tobytes())
    with pytest.raises(Exception, match="size does not fit"):
        scan_vecs(spark, str(tmp_path / "c.ivecs")).collect()
    with pytest.raises(ValueError):
        scan_vecs(spark, "x", "bvecs")


def test_parts_of_different_dimension_are_not_committed(spark, tmp_path):
    good = spark.createDataFrame([(0, [7])], "k long, vector array<long>")
    write_vecs(good, "k", str(tmp_path / "d"), "ivecs")
    rows = [(i, [1, 2, 3] if i < 50 else [1, 2]) for i in range(100)]
    mixed = spark.createDataFrame(rows, "k long, vector array<long>")
    with pytest.raises(Exception, match="dimension"):
        write_vecs(mixed, "k", str(tmp_path / "d"), "ivecs", partitions=8)
    assert matrix(scan_vecs(spark, str(tmp_path / "d"))).tolist() == [[7]]  # the old set is untouched


def test_uri_keeps_its_authority_and_options():
    assert _around("hdfs://nn:8020/a/x", "/a/x") == ("hdfs://nn:8020", "")
    assert _around("s3://bucket/a/?region=eu", "bucket/a") == ("s3://", "?region=eu")
    assert _around("/a/b?c", "/a/b?c") == ("", "")
    assert _around("file:/a", "/a") == ("file:", "")


def test_query_set_in_parts_is_numbered_through(spark, tmp_path, rng):
    m = rng.normal(size=(100, 3)).astype(np.float32)
    write_npy(vector_frame(spark, range(100), m, "k"), "k", str(tmp_path / "q"), min_parts=3)
    assert len(list((tmp_path / "q").rglob("*.npy"))) == 3
    rows = scan_npy_set(spark, str(tmp_path / "q")).orderBy("qid").collect()
    assert [r.qid for r in rows] == list(range(100))
    np.testing.assert_array_equal(np.array([r.vector for r in rows]), m)


def test_npy_round_trip(spark, tmp_path, rng):
    m = rng.normal(size=(60, 4)).astype(np.float32)
    df = vector_frame(spark, range(60), m, "k")
    write_npy(df, "k", str(tmp_path / "one"))
    (file,) = (tmp_path / "one").rglob("*.npy")
    np.testing.assert_array_equal(np.load(file), m)
    write_npy(df, "k", str(tmp_path / "many"), min_parts=4)
    files = sorted((tmp_path / "many").rglob("*.npy"))
    assert len(files) == 4
    np.testing.assert_array_equal(np.concatenate([np.load(f) for f in files]), m)
    np.testing.assert_array_equal(matrix(scan_npy(spark, str(tmp_path / "many"))), m)


def test_structured_partial_results(spark, tmp_path):
    kinds = {"i4f4": [("idx", "i4"), ("distance", "f4")], "i8f8": [("idx", "i8"), ("distance", "f8")]}
    for n, (name, dtype) in enumerate(kinds.items()):
        m = np.empty((3, 2), dtype)
        m["idx"] = np.arange(6).reshape(3, 2) + 10 * n
        m["distance"] = np.arange(6).reshape(3, 2) / 4 + n / 8
        np.save(tmp_path / f"{name}.npy", m)
    parts = scan_neighbors(spark, str(tmp_path), fmt="npy")
    assert parts.schema.simpleString() == "struct<qid:bigint,rank:int,id:bigint,distance:double>"
    best = merge_topk(parts, k=3, metric="l2").where("qid = 1").orderBy("rank").collect()
    assert [(r.id, r.distance) for r in best] == [(2, 0.5), (12, 0.625), (3, 0.75)]


def test_neighbors_parquet(spark, tmp_path):
    df = spark.range(20).selectExpr(
        "id % 4 qid", "cast(id as int) rank", "id", "id / 2 distance", "id % 3 shard_group"
    )
    write_neighbors(df, str(tmp_path / "n"), "shard_group")
    write_neighbors(df.where("shard_group = 1"), str(tmp_path / "n"), "shard_group")
    back = scan_neighbors(spark, str(tmp_path / "n"))
    assert set(back.collect()) == set(df.drop("shard_group").collect())


def test_file_number_of_parts(spark, tmp_path, rng):
    write_npy(vector_frame(spark, range(9), rng.normal(size=(9, 2)), "k"), "k", str(tmp_path), min_parts=3)
    found = scan_npy(spark, str(tmp_path)).select(shard_number("shard").alias("n")).distinct()
    assert {r.n for r in found.collect()} == {0, 1, 2}
    assert found.where(F.col("n").isNull()).count() == 0


def test_shapes_from_headers(spark, tmp_path):
    for n in range(3):
        np.save(tmp_path / f"p_{n}.npy", np.zeros((n * 5, 4), "f2"))
    found = {(r.shard, r.n_rows, r.dim) for r in npy_shapes(spark, str(tmp_path)).collect()}
    assert found == {("p_0.npy", 0, 4), ("p_1.npy", 5, 4), ("p_2.npy", 10, 4)}


def test_planning_opens_no_file(tmp_path, monkeypatch):
    """A thousand files are planned from their listed sizes; opening one would fail."""
    for n in range(1000):
        np.save(tmp_path / f"emb_{n:04d}.npy", np.zeros((n % 7, 3), "f4"))
    opened = []
    real = vecfiles.open_fs

    class Closed:
        def __init__(self, fs):
            self.fs = fs

        def get_file_info(self, at):
            return self.fs.get_file_info(at)

        def open_input_file(self, path):
            opened.append(path)
            raise AssertionError("opened on the driver")

    monkeypatch.setattr(vecfiles, "open_fs", lambda path: (Closed(real(path)[0]), real(path)[1]))
    for kind in ("npy", "shape"):
        pieces = VecFileReader(kind, [str(tmp_path)], 64 << 20).partitions()
        assert sorted(p for x in pieces for p, _, _ in x.parts) == sorted(str(p) for p in tmp_path.glob("*.npy"))
        assert 50 < len(pieces) < 100
    assert not opened


def test_pieces_cover_every_row():
    files = [("a", 10), ("b", 1000), ("c", 0), ("d", 301), ("e", 100)]
    parts = [x for p in plan_pieces(files, 100) for x in p.parts]
    assert {p for p, _, _ in parts} == {"a", "b", "c", "d", "e"}
    for path, size in files:
        own = [(i, n) for p, i, n in parts if p == path]
        assert own == [(i, max(1, -(-size // 100))) for i in range(max(1, -(-size // 100)))]


def test_failed_commit_leaves_the_old_version(spark, tmp_path, rng, monkeypatch):
    """Whatever fails before the pointer is switched, readers keep the version before; repeated writes leave two."""
    dest = tmp_path / "d"
    old, new = (rng.normal(size=(n, 3)).astype(np.float32) for n in (40, 30))

    def write(m):
        write_npy(vector_frame(spark, range(len(m)), m, "k"), "k", str(dest), min_parts=3)

    write(old)
    writer = VecFileWriter("npy", str(dest))
    folder = dest / writer.folder
    folder.mkdir()
    np.save(folder / "part-000000.npy", new)  # a job that died before its commit
    np.testing.assert_array_equal(matrix(scan_npy(spark, str(dest))), old)
    fs = pafs.LocalFileSystem()

    class Broken:
        def __getattr__(self, name):
            return getattr(fs, name)

        def open_output_stream(self, path):
            raise OSError("storage is gone")

    real = vecfiles.open_fs
    monkeypatch.setattr(vecfiles, "open_fs", lambda path: (Broken(), real(path)[1]))
    with pytest.raises(OSError):
        writer.commit([])
    monkeypatch.setattr(vecfiles, "open_fs", real)
    np.testing.assert_array_equal(matrix(scan_npy(spark, str(dest))), old)
    for m in (new, old, new):
        before = current_folder(str(dest))
        write(m)
        np.testing.assert_array_equal(matrix(scan_npy(spark, str(dest))), m)
        assert {str(p) for p in dest.glob("version-*")} == {before, current_folder(str(dest))}
    assert len(list_files([str(tmp_path)], ".npy")) == 3
    none = vector_frame(spark, [], np.zeros((0, 3)), "k")
    write_npy(none, "k", str(dest))
    assert scan_npy(spark, str(dest)).count() == 0


def test_neighbor_matrices(spark, tmp_path):
    """Lists of every length, queries without one, several parts per group; rows keep their place."""
    rows = [
        (g, q, r, 100 * g + 10 * q + r, float(r) + g / 4)
        for g in range(3) for q in range(0, 50, 1 + g) for r in range(1, 1 + min(4, q % 6))
    ]
    df = spark.createDataFrame(rows, "g long, qid long, rank int, id long, distance double").repartition(5)
    write_npy_neighbors(df, str(tmp_path / "m"), 4, group="g", part_bytes=16 * 4 * 10)
    names = [Path(p).name for p, _ in list_files([str(tmp_path / "m")], ".npy")]
    assert sum(n.startswith("part-000000") for n in names) == 5 and "part-000001-r000000000040.npy" in names
    assert np.load(Path(current_folder(str(tmp_path / "m"))) / names[0]).dtype.names == ("idx", "distance")
    found = scan_npy_neighbors(spark, str(tmp_path / "m")).collect()
    assert sorted(tuple(r) for r in found) == sorted(r[1:] for r in rows)
    for bad in ((0, -1, 1, 5, 0.5), (0, 1, 5, 5, 0.5), (0, 1, 1, -1, 0.5)):
        with pytest.raises(Exception, match="cannot be a row of a matrix"):
            write_npy_neighbors(spark.createDataFrame([bad], df.schema), str(tmp_path / "bad"), 4)


def test_files_by_shard(spark, tmp_path, rng):
    m = rng.normal(size=(50, 3)).astype(np.float32)
    df = vector_frame(spark, range(50), m, "k").withColumn("file", F.expr("k DIV 8"))
    write_shards(df, "file", "k", str(tmp_path / "v"), template="emb_%04d.npy")
    np.testing.assert_array_equal(np.load(Path(current_folder(str(tmp_path / "v"))) / "emb_0002.npy"), m[16:24])
    write_shards(df, "file", "k", str(tmp_path / "p"), "parquet", "meta_%04d.parquet")
    table = pq.read_table(Path(current_folder(str(tmp_path / "p"))) / "meta_0006.parquet")
    assert table.column_names == ["k", "vector"] and table["k"].to_pylist() == [48, 49]
