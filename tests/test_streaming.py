import numpy as np
import pyarrow as pa
import pytest
from conftest import vector_frame

from nearfield.operators.knn import knn
from nearfield.plans import assembly
from nearfield.streaming import ingest as ingest_module
from nearfield.streaming import neighbors as neighbors_module
from nearfield.streaming import shards as shards_module
from nearfield.streaming.ingest import ingest_incremental
from nearfield.streaming.neighbors import knn_incremental
from nearfield.streaming.shards import ShardReader


def save(folder, shards):
    folder.mkdir(exist_ok=True)
    for no, m in shards.items():
        np.save(folder / f"emb_{no:04d}.npy", m)


def run(spark, tmp_path, **options):
    return ingest_incremental(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "manifest"),
        checkpoint=str(tmp_path / "cp"), global_start=1000, **options,
    )


def content(spark, tmp_path):
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("pk").collect()
    return [r.pk for r in rows], [r.pk_5b for r in rows], np.array([r.float32_vector for r in rows])


def test_keys_continue_over_restarts(spark, tmp_path, rng, monkeypatch):
    parts = {n: rng.normal(size=(r, 3)).astype(np.float32) for n, r in enumerate([5, 2, 7, 4])}
    save(tmp_path / "in", {2: parts[2], 0: parts[0], 1: parts[1]})  # arrival is not number order
    batches = []
    real = ingest_module.new_shards

    def seen(shards, manifest):
        batches.append([r.shard_no for r in real(shards, manifest)])
        return real(shards, manifest)

    monkeypatch.setattr(ingest_module, "new_shards", seen)
    first = run(spark, tmp_path, shards_per_step=2)
    assert batches == [[0, 1], [2]]  # number order, two names at a time
    assert [(r.shard_no, r.n_rows, r.pk_start) for r in first.orderBy("shard_no").collect()] == [
        (0, 5, 0), (1, 2, 5), (2, 7, 7),
    ]
    again = run(spark, tmp_path)
    assert again.count() == 3
    save(tmp_path / "in", {3: parts[3]})
    run(spark, tmp_path)
    pk, pk_global, vectors = content(spark, tmp_path)
    assert pk == list(range(18)) and pk_global == list(range(1000, 1018))
    np.testing.assert_array_equal(vectors, np.concatenate([parts[i] for i in range(4)]))


def test_crash_between_table_and_manifest(spark, tmp_path, rng, monkeypatch):
    parts = {n: rng.normal(size=(4, 3)).astype(np.float32) for n in range(3)}
    save(tmp_path / "in", parts)
    real = ingest_module._key_ranges
    calls = []

    def crash(table, numbers):
        calls.append(numbers)
        if len(calls) == 2:
            raise RuntimeError("executor lost")
        return real(table, numbers)

    monkeypatch.setattr(ingest_module, "_key_ranges", crash)
    with pytest.raises(Exception, match="executor lost"):
        run(spark, tmp_path, shards_per_step=1)
    monkeypatch.setattr(ingest_module, "_key_ranges", real)
    run(spark, tmp_path, shards_per_step=1)
    pk, _, vectors = content(spark, tmp_path)
    assert pk == list(range(12))
    np.testing.assert_array_equal(vectors, np.concatenate([parts[i] for i in range(3)]))


def test_equal_shard_numbers_are_an_error(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, rows in (("a_0001.npy", 5), ("b_0001.npy", 7)):
        np.save(tmp_path / "in" / name, np.zeros((rows, 2), np.float32))
    with pytest.raises(Exception, match="a_0001.npy and b_0001.npy have the same shard number"):
        run(spark, tmp_path)


def test_late_lower_shard_is_an_error(spark, tmp_path):
    save(tmp_path / "in", {5: np.zeros((2, 2), np.float32)})
    run(spark, tmp_path)
    save(tmp_path / "in", {4: np.zeros((2, 2), np.float32)})
    with pytest.raises(Exception, match="shard 4 arrived after shard 5"):
        run(spark, tmp_path)


@pytest.mark.parametrize("bad", [np.zeros((2, 3)), np.full((2, 2), np.nan), np.full((2, 2), np.inf)])
def test_unusable_vectors_are_rejected(spark, tmp_path, bad):
    save(tmp_path / "in", {0: np.zeros((2, 2), np.float32), 1: bad.astype(np.float32)})
    with pytest.raises(Exception, match="dimension"):
        run(spark, tmp_path)


def test_empty_shard(spark, tmp_path):
    save(tmp_path / "in", {0: np.ones((2, 2)), 1: np.zeros((0, 2)), 2: np.ones((3, 2))})
    rows = run(spark, tmp_path).orderBy("shard_no").collect()
    assert [(r.shard_no, r.n_rows) for r in rows] == [(0, 2), (1, 0), (2, 3)]
    assert content(spark, tmp_path)[0] == list(range(5))


def metadata(spark, folder, no, n):
    folder.mkdir(exist_ok=True)
    df = spark.range(n).selectExpr(
        f"concat('c{no}-', id) caption", "'UNLIKELY' NSFW", "0.5D similarity", "10L width", "20L height",
        "30L original_width", "40L original_height", "md5(cast(id as string)) md5", "id extra",
    )
    df.coalesce(1).write.parquet(str(folder / f"tmp{no}"))
    part = next((folder / f"tmp{no}").glob("part-*.parquet"))
    (folder / f"metadata_{no:04d}.parquet").write_bytes(part.read_bytes())


def test_with_metadata(spark, tmp_path, rng):
    parts = {n: rng.normal(size=(3, 2)).astype(np.float32) for n in range(2)}
    save(tmp_path / "in", parts)
    for n in parts:
        metadata(spark, tmp_path / "meta", n, 3)
    run(spark, tmp_path, metadata_template=str(tmp_path / "meta" / "metadata_%04d.parquet"))
    out = spark.read.parquet(str(tmp_path / "out")).orderBy("pk")
    assert out.columns == [
        "pk", "pk_5b", "caption", "NSFW", "similarity", "width", "height", "original_width",
        "original_height", "md5", "float32_vector", "shard_no",
    ]
    assert [r.caption for r in out.collect()] == [f"c{n}-{i}" for n in range(2) for i in range(3)]


def test_unequal_metadata_is_an_error(spark, tmp_path):
    save(tmp_path / "in", {0: np.zeros((3, 2), np.float32)})
    metadata(spark, tmp_path / "meta", 0, 4)
    with pytest.raises(Exception, match="4 metadata rows, 3 vectors"):
        run(spark, tmp_path, metadata_template=str(tmp_path / "meta" / "metadata_%04d.parquet"))


def test_shard_offsets(tmp_path):
    """Offsets go up in steps, a repeated range lists the same shards, a restart begins behind the manifest."""
    save(tmp_path / "in", {n: np.zeros((1, 2)) for n in (3, 0, 7, 12, 5)})
    reader = ShardReader(str(tmp_path / "in"), ".npy", -1, 2)
    ends = [reader.initialOffset()["shard"]] + [reader.latestOffset()["shard"] for _ in range(4)]
    assert ends == [-1, 3, 7, 12, 12]
    (part,) = reader.partitions({"shard": 3}, {"shard": 7})
    assert [(no, shard) for _, shard, no in reader.read(part)] == [(5, "emb_0005.npy"), (7, "emb_0007.npy")]
    again = ShardReader(str(tmp_path / "in"), ".npy", 3, 2)
    again.partitions({"shard": 3}, {"shard": 7})  # the batch under way when the job died
    assert again.latestOffset() == {"shard": 12}
    np.save(tmp_path / "in" / "nameless.npy", np.zeros((1, 2)))
    with pytest.raises(ValueError, match="without a number"):
        reader.latestOffset()


def test_steps_store_changed_lists_only(spark, tmp_path, rng, monkeypatch):
    """State rows and written lists of a step are those of the queries it changes; tables are put together later."""
    monkeypatch.setattr(neighbors_module, "COMPACT_FROM", 3)
    qs = np.array([[0.0, 0.0], [10.0, 0.0], [0.0, 10.0], [10.0, 10.0]])
    q = vector_frame(spark, range(4), qs, "qid")
    near = np.concatenate([qs + rng.normal(scale=0.01, size=(4, 2)) for _ in range(3)])
    steps = [near, np.array([[0.001, 0.0]]), np.array([[500.0, 500.0]]), np.array([[10.0, 10.0], [0.0, 9.999]])]
    source, state, start = str(tmp_path / "in"), str(tmp_path / "state"), 0
    for m, touched in zip(steps, (4, 1, 0, 2)):
        vector_frame(spark, range(start, start + len(m)), m).coalesce(1).write.mode("append").parquet(source)
        start += len(m)
        progress = []
        found = knn_incremental(spark, source, q, 3, "l2", state, progress=progress)
        assert sum(p.stateOperators[0].numRowsUpdated for p in progress if p.stateOperators) == touched
        everything = vector_frame(spark, range(start), np.concatenate(steps)[:start])
        assert set(found.collect()) == set(knn(everything, q, 3, "l2").collect())
    assert (tmp_path / "state" / "whole").exists()


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_running_neighbors_equal_the_batch_result(spark, tmp_path, rng, metric):
    base, qs = rng.normal(size=(90, 4)), rng.normal(size=(6, 4))
    q = vector_frame(spark, range(6), qs, "qid")
    everything = vector_frame(spark, range(90), base)
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    for step, (lo, hi) in enumerate([(0, 30), (30, 31), (31, 90)]):
        everything.where(f"pk >= {lo} and pk < {hi}").coalesce(2).write.mode("append").parquet(source)
        found = knn_incremental(spark, source, q, 5, metric, state)
        so_far = knn(everything.where(f"pk < {hi}"), q, 5, metric)
        assert set(found.collect()) == set(so_far.collect()), step
    assert set(knn_incremental(spark, source, q, 5, metric, state).collect()) == set(so_far.collect())


def test_steps_do_not_read_the_manifest_again(spark, tmp_path, rng, monkeypatch):
    """What a step costs does not grow with the steps before it: the manifest is read at most three times a call."""
    parts = {n: rng.normal(size=(2, 3)).astype(np.float32) for n in range(5)}
    save(tmp_path / "in", parts)
    reads = []
    real = ingest_module.read_manifest
    monkeypatch.setattr(ingest_module, "read_manifest", lambda *a: reads.append(1) or real(*a))
    assert run(spark, tmp_path, shards_per_step=1).count() == 5
    assert len(reads) <= 3
    pk, _, vectors = content(spark, tmp_path)
    assert pk == list(range(10))
    np.testing.assert_array_equal(vectors, np.concatenate([parts[i] for i in range(5)]))


def test_a_batch_lists_the_folder_once(tmp_path, monkeypatch):
    save(tmp_path / "in", {n: np.zeros((1, 2)) for n in range(4)})
    lists = []
    real = shards_module.numbered_files
    monkeypatch.setattr(shards_module, "numbered_files", lambda *a: lists.append(1) or real(*a))
    reader = ShardReader(str(tmp_path / "in"), ".npy", -1, 2)
    end = reader.latestOffset()
    (part,) = reader.partitions({"shard": -1}, end)
    assert [no for _, _, no in reader.read(part)] == [0, 1] and len(lists) == 1


@pytest.mark.parametrize(("n", "files"), [(1_200, 3), (24_000, 16)])
def test_files_of_an_ingest_grow_with_the_table(spark, tmp_path, n, files):
    """Beyond 16 files it is their size that grows, so the steps of an ingest stay few."""
    rows = spark.range(n).selectExpr("id AS vec_id", "array(float(id), float(1)) AS embedding", "int(0) AS label")
    rows.write.parquet(str(tmp_path / "embeddings.parquet"))
    file_rows = assembly._file_rows(spark, str(tmp_path))
    assert file_rows >= assembly.FILE_ROWS and -(-n // file_rows) == files


@pytest.mark.parametrize("descending", [False, True])
def test_candidates_are_trimmed_before_the_state(rng, monkeypatch, descending):
    monkeypatch.setattr(neighbors_module, "TRIM_ROWS", 50)
    qids, ids = rng.integers(0, 9, 400), rng.permutation(400)
    distances = rng.integers(0, 12, 400).astype(float)  # many ties
    frame = pa.RecordBatch.from_arrays([pa.array(c) for c in (qids, ids, distances)], names=["qid", "id", "distance"])
    out = neighbors_module._trim(3, descending)(frame.slice(at, 40) for at in range(0, 400, 40))
    found = [tuple(r.values()) for b in out for r in b.to_pylist()]
    rows = sorted(zip(qids.tolist(), ids.tolist(), distances.tolist()), key=lambda r: (r[0], -r[2] if descending else r[2], r[1]))
    assert found == [r for q in range(9) for r in [r for r in rows if r[0] == q][:3]]
    assert list(neighbors_module._trim(3, descending)(iter([frame.slice(0, 0)]))) == []


def test_few_files_are_searched_by_all_cores(spark, tmp_path, rng, monkeypatch):
    """A step of one file is not one task's work, and its state gets k candidates a query all the same."""
    m = rng.normal(size=(64, 3)).astype(np.float32)
    vector_frame(spark, range(64), m).coalesce(1).write.parquet(str(tmp_path / "in"))
    tasks, real = [], neighbors_module.candidate_pairs

    def seen(base, *a, **b):
        tasks.append(base._jdf.queryExecution().analyzed().toString())
        return real(base, *a, **b)

    monkeypatch.setattr(neighbors_module, "candidate_pairs", seen)
    q = vector_frame(spark, range(64), m, "qid")
    found = knn_incremental(spark, str(tmp_path / "in"), q, 4, "cosine", str(tmp_path / "state"), files_per_step=1)
    assert "RepartitionByExpression" in tasks[0]
    truth = knn(vector_frame(spark, range(64), m), q, 4, "cosine")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, truth.select(found.columns).collect()))
