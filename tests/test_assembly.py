import numpy as np
import pytest

from nearfield import schemas
from nearfield.operators import ordinals
from nearfield.operators.coread import zip_in_place
from nearfield.operators.assembly import (
    assign_pk,
    audit_shards,
    count_mismatches,
    filter_vectors,
    missing_shards,
    pending_shards,
    renumber_shards,
    shard_counts,
    zip_shards,
)
from nearfield.operators.checks import check_dimension, dimension_report, enforce_schema
from nearfield.sources.links import shard_paths
from nearfield.sources.tables import list_shards, scan_vectors, write_vectors


def shards(spark, sizes, value="v"):
    """One row per (shard, position)."""
    rows = [(s, i, f"{s}:{i}") for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, f"shard_no long, row_index long, {value} string").repartition(4)


def test_keys_are_contiguous_in_shard_then_row_order(spark):
    df = assign_pk(shards(spark, {3: 4, 0: 5, 7: 1}), start=3_952_540_762, global_start=10)
    rows = df.orderBy("shard_no", "row_index").collect()
    assert [r.pk for r in rows] == list(range(3_952_540_762, 3_952_540_772))
    assert [r.pk_global for r in rows] == list(range(10, 20))


def test_keys_without_row_numbers(spark):
    rows = [("b", 5), ("a", 9), ("a", 2), ("b", 1)]
    df = assign_pk(spark.createDataFrame(rows, "src string, id long"), shard="src", row=None, order=["id"])
    assert [(r.src, r.id, r.pk) for r in df.orderBy("pk").collect()] == [
        ("a", 2, 0), ("a", 9, 1), ("b", 1, 2), ("b", 5, 3),
    ]


def test_gap_in_row_numbers_is_an_error(spark):
    df = shards(spark, {0: 4}).where("row_index <> 2")
    with pytest.raises(Exception, match="gaps in shard"):
        assign_pk(df).collect()


def test_hot_shard_and_shuffle_join(spark, monkeypatch):
    monkeypatch.setattr(ordinals, "BROADCAST_ROWS", 0)
    df = assign_pk(shards(spark, {0: 500, 1: 3, 2: 2}))
    assert sorted(r.pk for r in df.collect()) == list(range(505))


def test_zip(spark):
    meta, vectors = shards(spark, {0: 3, 1: 2}, "m"), shards(spark, {0: 3, 1: 2})
    assert all(r.m == r.v for r in zip_shards(meta, vectors).collect())
    assert zip_shards(meta, vectors).count() == 5


def test_zip_of_unequal_shards(spark):
    meta, vectors = shards(spark, {0: 3, 1: 2, 2: 2}, "m"), shards(spark, {0: 3, 1: 4})
    bad = {(r.shard_no, r.n_meta, r.n_vectors) for r in count_mismatches(meta, vectors).collect()}
    assert bad == {(1, 2, 4), (2, 2, 0)}
    with pytest.raises(ValueError, match="shard 1: 2 metadata rows, 4 vectors"):
        zip_shards(meta, vectors)
    assert {r.shard_no for r in zip_shards(meta, vectors, on_mismatch="skip").collect()} == {0}


def test_renumber(spark):
    df = renumber_shards(shards(spark, {3566: 1, 3567: 2, 5817: 1, 5818: 1}), 3567, 5818)
    assert sorted(r.shard_no for r in df.collect()) == [0, 0, 2250]


def test_audit_and_pending(spark):
    expected = spark.range(5).selectExpr("concat('s', id) shard")
    present = expected.where("shard not in ('s2', 's4')")
    with pytest.raises(FileNotFoundError, match="s2"):
        audit_shards(expected, present)
    assert audit_shards(expected, present, "skip").count() == 3
    assert audit_shards(present, expected).count() == 3
    assert {r.shard for r in missing_shards(expected, present).collect()} == {"s2", "s4"}
    assert {r.shard for r in pending_shards(expected, present).collect()} == {"s2", "s4"}
    with pytest.raises(ValueError):
        audit_shards(expected, present, "ignore")


def test_counts_and_filter(spark):
    df = filter_vectors(shards(spark, {0: 3, 2: 4}), "row_index > 0")
    assert [tuple(r) for r in shard_counts(df).orderBy("shard_no").collect()] == [(0, 2, 2), (2, 3, 5)]
    assert filter_vectors(df, None) is df


def test_missing_values_follow_sql(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "pk long, category string")
    assert [r.pk for r in filter_vectors(df, "category != 'a'").collect()] == [3]


def test_schema_and_dimension(spark):
    df = spark.createDataFrame([([1.5, 2.0], "7")], "float32_vector array<double>, pk string")
    typed = enforce_schema(df, schemas.BARE_VECTORS)
    assert typed.schema.simpleString() == "struct<pk:bigint,float32_vector:array<float>>"
    assert check_dimension(typed, "float32_vector", 2) is typed
    with pytest.raises(ValueError, match="dimensions 2..2"):
        check_dimension(typed, "float32_vector", 3)
    mixed = spark.createDataFrame(
        [([1.0],), ([1.0, 2.0],), ([float("nan")],), ([None],), (None,), ([float("inf")],)],
        "vector array<float>",
    )
    r = dimension_report(mixed).first()
    assert (r.n_rows, r.max_dim, r.null_vectors, r.bad_vectors) == (6, 2, 1, 3)
    with pytest.raises(ValueError, match="NULL"):
        check_dimension(mixed)


def test_rewriting_a_shard_replaces_only_that_shard(spark, tmp_path):
    dest = str(tmp_path / "vectors")
    df = assign_pk(shards(spark, {0: 3, 1: 4})).selectExpr(
        "pk", "shard_no", "array(cast(pk as float)) float32_vector"
    )
    write_vectors(df, dest, schemas.BARE_VECTORS, rows_per_file=2)
    write_vectors(df.where("shard_no = 1"), dest, schemas.BARE_VECTORS)
    back = spark.read.parquet(dest)
    assert sorted(r.pk for r in back.collect()) == list(range(7))


def test_scan_keeps_file_and_position(spark, tmp_path):
    for n in (4, 12):
        spark.range(n, n + 3).selectExpr("id pk", "'x' caption").coalesce(1).write.parquet(str(tmp_path / f"d{n}"))
        part = next((tmp_path / f"d{n}").glob("part-*.parquet"))
        (tmp_path / f"meta_{n:04d}.parquet").write_bytes(part.read_bytes())
    found = scan_vectors(spark, [str(tmp_path / f"meta_{n:04d}.parquet") for n in (4, 12)], ["pk"])
    assert found.columns == ["shard", "shard_no", "row_index", "pk"]
    assert {(r.shard_no, r.row_index, r.pk) for r in found.collect()} == {
        (n, i, n + i) for n in (4, 12) for i in range(3)
    }
    text = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert "caption" not in text.split("ReadSchema")[-1].split("\n")[0]


def test_audit_of_a_folder(spark, tmp_path):
    for n in (0, 1, 3):
        (tmp_path / f"part_{n:04d}.npy").write_bytes(b"x" * (n + 1))
    (tmp_path / "notes.txt").write_text("x")
    present = list_shards(spark, str(tmp_path), "*.npy")
    assert {(r.shard, r.shard_no, r.n_bytes) for r in present.collect()} == {
        ("part_0000.npy", 0, 1), ("part_0001.npy", 1, 2), ("part_0003.npy", 3, 4),
    }
    expected = shard_paths(spark, "part_%04d.npy", 0, 4).withColumnRenamed("path", "shard")
    with pytest.raises(FileNotFoundError, match="part_0002.npy"):
        audit_shards(expected, present)
    assert audit_shards(expected, present, "skip").count() == 3


def test_zip_in_place(spark, tmp_path, rng):
    """No exchange, ranges of the vector files only; uneven shards raise or go; filters come first."""
    sizes = {0: 7, 1: 9000, 2: 5}
    parts = {n: rng.normal(size=(rows, 3)).astype(np.float32) for n, rows in sizes.items()}
    for n, m in parts.items():
        np.save(tmp_path / f"emb_{n:04d}.npy", np.asfortranarray(m) if n == 2 else m)
    rows = [(n, i, f"{n}-{i}") for n, size in sizes.items() for i in range(size)]
    spark.createDataFrame(rows, "shard_no int, row_index long, caption string").repartition(3, "shard_no").sortWithinPartitions(
        "shard_no", "row_index"
    ).write.parquet(str(tmp_path / "meta"))
    meta = spark.read.parquet(str(tmp_path / "meta"))
    template = str(tmp_path / "emb_%04d.npy")
    found = zip_in_place(meta, template)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.columns == ["shard_no", "row_index", "caption", "vector"]
    for r in found.collect():
        assert r.caption == f"{r.shard_no}-{r.row_index}"
        np.testing.assert_array_equal(np.array(r.vector, np.float32), parts[r.shard_no][r.row_index])
    some = zip_in_place(meta.where("row_index % 1000 = 3"), template, on_mismatch="ignore").collect()
    assert sorted((r.shard_no, r.row_index) for r in some) == [(0, 3)] + [(1, 1000 * i + 3) for i in range(9)] + [(2, 3)]
    short = meta.where("NOT (shard_no = 0 AND row_index = 6)")
    with pytest.raises(ValueError, match="shard 0: 6 metadata rows, 7 vectors"):
        zip_in_place(short, template)
    assert {r.shard_no for r in zip_in_place(short, template, on_mismatch="skip").collect()} == {1, 2}
    more = meta.unionByName(spark.createDataFrame([(2, 5, "x")], meta.schema))
    with pytest.raises(Exception, match="no vector for metadata row 5"):
        zip_in_place(more, template, on_mismatch="ignore").collect()
    assert zip_in_place(meta.limit(0), template).count() == 0
