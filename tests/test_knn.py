"""Neighbour search against all pairs in NumPy."""

import numpy as np
import pytest
from conftest import assert_neighbors, brute_force, vector_frame
from pyspark.sql import functions as F

from nearfield.operators import knn as knn_module
from nearfield.operators.knn import knn

METRICS = ["l2", "cosine", "cosine_distance"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 12)) * rng.uniform(0.1, 30, size=(400, 1))
    base[7] = 0
    base[100] = base[50]
    base[333] = base[50]
    ids = rng.permutation(400) + 3_000_000_000
    qs = np.vstack([rng.normal(size=(22, 12)), base[50:51], base[100:101], np.zeros((1, 12))])
    qids = np.arange(len(qs)) * 3
    return ids, base, qids, qs


def frames(spark, data, **extra):
    ids, base, qids, qs = data
    return vector_frame(spark, ids, base, **extra), vector_frame(spark, qids, qs, "qid")


@pytest.mark.parametrize("metric", METRICS)
def test_broadcast_matches_brute_force(spark, data, metric):
    b, q = frames(spark, data)
    ids, base, qids, qs = data
    # The zero query ties every row under the angle metrics; ids decide.
    assert_neighbors(knn(b, q, 9, metric), brute_force(ids, base, qids, qs, 9, metric))


@pytest.mark.parametrize("metric", METRICS)
def test_streamed_query_blocks_match_brute_force(spark, data, metric, monkeypatch):
    monkeypatch.setattr(knn_module, "HELD_BYTES", 500)  # several runs of base rows a task
    b, q = frames(spark, data)
    ids, base, qids, qs = data
    found = knn(b, q, 9, metric, query_blocks=3, query_block=4)
    assert_neighbors(found, brute_force(ids, base, qids, qs, 9, metric))


@pytest.mark.parametrize("blocks", [None, 2])
def test_pilot_keeps_the_answer(spark, data, blocks):
    b, q = frames(spark, data)
    ids, base, qids, qs = data
    found = knn(b, q, 7, "l2", prune_fraction=0.3, query_blocks=blocks)
    assert_neighbors(found, brute_force(ids, base, qids, qs, 7, "l2"))


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("blocks", [None, 2])
def test_known_bounds_prune_and_keep_the_answer(spark, data, metric, blocks):
    b, q = frames(spark, data)
    ids, base, qids, qs = data
    first = knn(b.where("pk % 2 = 0"), q, 5, metric)
    bounds = knn_module.kth_bounds(first, 5, metric)
    rest = knn(b.where("pk % 2 = 1"), q, 5, metric, bounds=bounds, query_blocks=blocks)
    assert rest.count() < 5 * len(qids)  # rows beyond the bounds were left out
    merged = knn_module.top_k(first.drop("rank").unionByName(rest.drop("rank")), 5, knn_module.get_metric(metric))
    assert_neighbors(merged, brute_force(ids, base, qids, qs, 5, metric))


def test_nested_pilot_is_chosen_by_row_count(spark, data, monkeypatch):
    monkeypatch.setattr(knn_module, "PILOT_FROM", 100)
    monkeypatch.setattr(knn_module, "PILOT_FRACTION", 0.4)
    b, q = frames(spark, data)
    ids, base, qids, qs = data
    assert_neighbors(knn(b, q, 5, "cosine"), brute_force(ids, base, qids, qs, 5, "cosine"))


def test_pilot_smaller_than_k(spark, data):
    b, q = frames(spark, data)
    ids, base, qids, qs = data
    found = knn(b, q, 30, "l2", prune_fraction=0.02)
    assert_neighbors(found, brute_force(ids, base, qids, qs, 30, "l2"))


@pytest.mark.parametrize("per", [None, "shard"])
def test_large_query_set_moves_no_base_row(spark, tmp_path, data, monkeypatch, per):
    b, q = frames(spark, data)
    ids, base, qids, qs = data
    b.selectExpr("*", "pk % 3 shard").write.parquet(str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b"))
    whole = knn(stored, q, 4, "l2", per=per)

    def refused(*_):
        raise AssertionError("vectors came to the driver")

    monkeypatch.setattr(knn_module, "_broadcast", refused)
    monkeypatch.setattr(knn_module, "HELD_BYTES", 500)
    found = knn(stored, q, 4, "l2", broadcast_bytes=500, per=per)
    assert "Exchange" not in plan_text(found).split("MapInArrow")[-1]
    if per is None:
        assert_neighbors(found, brute_force(ids, base, qids, qs, 4, "l2"))
    else:
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))


def plan_text(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_base_is_not_shuffled_before_the_search(spark, tmp_path, data):
    b, q = frames(spark, data)
    b.write.parquet(str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b"))
    text = plan_text(knn(stored, q, 4, "l2", expr="pk > 3000000100"))
    below = text.split("MapInArrow")[-1]
    assert "Exchange" not in below
    assert "GreaterThan(pk,3000000100)" in below


def test_filter_before_search(spark, data):
    ids, base, qids, qs = data
    labels = (np.arange(400) % 7).tolist()
    b, q = frames(spark, data, label=labels)
    keep = [i for i in range(400) if labels[i] == 3]
    found = knn(b, q, 6, "l2", expr="label = 3")
    assert_neighbors(found, brute_force(ids[keep], base[keep], qids, qs, 6, "l2"))


def test_fewer_rows_than_k_gives_no_padding(spark, data):
    ids, base, qids, qs = data
    found = knn(vector_frame(spark, ids[:5], base[:5]), vector_frame(spark, qids, qs, "qid"), 9, "l2")
    assert_neighbors(found, brute_force(ids[:5], base[:5], qids, qs, 9, "l2"))
    none = knn(vector_frame(spark, ids, base), vector_frame(spark, qids, qs, "qid"), 9, "l2", expr="pk < 0")
    assert none.count() == 0


def test_no_queries(spark, data):
    b, q = frames(spark, data)
    found = knn(b, q.where("qid < 0"), 3, "l2")
    assert found.count() == 0
    assert found.columns == ["qid", "rank", "id", "distance"]


def test_normalized_base_orders_like_cosine(spark, data):
    ids, base, qids, qs = data
    qids, qs = qids[:-1], qs[:-1]  # seen from the zero query all unit vectors tie up to rounding
    b, q = frames(spark, (ids, base, qids, qs))
    found = knn(b, q, 8, "l2", normalize_base=True)
    assert_neighbors(found, brute_force(ids, base, qids, qs, 8, "l2", normalize_base=True))
    by_angle = knn(b, q, 8, "cosine").collect()
    assert {(r.qid, r.rank): r.id for r in found.collect()} == {(r.qid, r.rank): r.id for r in by_angle}


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 700}])
def test_lists_per_shard(spark, data, options):
    ids, base, qids, qs = data
    shards = (np.arange(400) % 3).tolist()
    b, q = frames(spark, data, shard_no=shards)
    found = knn(b, q, 5, "l2", per="shard_no", **options)
    for s in range(3):
        keep = [i for i in range(400) if shards[i] == s]
        assert_neighbors(found.where(f"shard_no = {s}"), brute_force(ids[keep], base[keep], qids, qs, 5, "l2"))


def test_close_vectors_far_from_the_origin(spark):
    """Single precision cannot rank these; the exact pass must."""
    rng = np.random.default_rng(1)
    base = 1000 + rng.normal(size=(300, 8)) * 0.01
    qs = base[:10] + 0.001
    b, q = vector_frame(spark, range(300), base), vector_frame(spark, range(10), qs, "qid")
    assert_neighbors(knn(b, q, 12, "l2"), brute_force(range(300), base, range(10), qs, 12, "l2"))


def test_huge_and_tiny_vectors(spark):
    rng = np.random.default_rng(2)
    for scale in (1e25, 1e-25):
        base = rng.normal(size=(60, 4)) * scale
        b, q = vector_frame(spark, range(60), base), vector_frame(spark, range(5), base[:5], "qid")
        rows = knn(b, q, 3, "cosine").collect()
        expected = brute_force(range(60), base, range(5), base[:5], 3, "cosine")
        assert {(r.qid, r.rank): r.id for r in rows} == {k: v[0] for k, v in expected.items()}


def test_many_copies_of_one_vector(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 6))
    base[100:200] = base[0]
    qs = base[:3]
    b, q = vector_frame(spark, range(300), base), vector_frame(spark, range(3), qs, "qid")
    expected = brute_force(range(300), base, range(3), qs, 20, "l2")
    assert_neighbors(knn(b, q, 20, "l2"), expected)
    assert_neighbors(knn(b, q, 20, "l2", query_blocks=2), expected)


@pytest.mark.parametrize("options", [{}, {"query_blocks": 2}])
def test_bad_input_is_rejected(spark, data, options):
    b, q = frames(spark, data)
    nan = vector_frame(spark, [1, 2], [[0.0] * 12, [float("nan")] * 12])
    with pytest.raises(Exception, match="NaN"):
        knn(nan, q, 2, "l2", **options).collect()
    ragged = spark.createDataFrame([(1, [1.0, 2.0])], "pk long, vector array<float>")
    with pytest.raises(Exception, match="dimension"):
        knn(ragged, q, 2, "l2", **options).collect()
    null = spark.createDataFrame([(1, None)], "pk long, vector array<float>")
    with pytest.raises(Exception, match="NULL"):
        knn(null, q, 2, "l2", **options).collect()
    with pytest.raises(ValueError, match="unique"):
        knn(b, q.unionByName(q), 2, "l2", **options)


def test_arguments(spark, data):
    b, q = frames(spark, data)
    with pytest.raises(ValueError, match="metric"):
        knn(b, q, 2, "manhattan")
    with pytest.raises(ValueError, match="positive"):
        knn(b, q, 0, "l2")


def test_pilot_of_whole_files(spark, tmp_path, rng):
    """The pilot filters on the file, which the scan prunes by; other bases are sampled; the answer stays."""
    x, q = rng.normal(size=(2000, 5)).astype(np.float32), rng.normal(size=(6, 5)).astype(np.float32)
    vector_frame(spark, range(2000), x).repartition(50).write.parquet(str(tmp_path / "b"))
    base = spark.read.parquet(str(tmp_path / "b")).where("pk >= 0").select("pk", "vector")
    pilot = knn_module._pilot_rows(base, 0.1)
    files = pilot.select(F.col("_metadata.file_path").alias("f")).distinct().count()
    assert 1 <= files <= 15 and pilot.count() == 40 * files and "_metadata" in pilot._jdf.queryExecution().executedPlan().toString()
    joined = base.groupBy("pk").agg(F.first("vector").alias("vector"))
    assert 50 < knn_module._pilot_rows(joined, 0.1).count() < 400
    assert "Sample" in knn_module._pilot_rows(base, 0.01)._jdf.queryExecution().toString()
    queries = vector_frame(spark, range(6), q, "qid")
    assert_neighbors(knn(base, queries, 7, "l2", prune_fraction=0.1), brute_force(range(2000), x, range(6), q, 7, "l2"))


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("per", [None, "shard"])
def test_queries_are_compared_in_bounded_parts(spark, rng, monkeypatch, metric, per):
    """A task keeps the lists of ``at_once`` queries, not of all, and the answer is the same over several runs of held rows."""
    base, qs = rng.normal(size=(400, 4)).astype(np.float32), rng.normal(size=(30, 4)).astype(np.float32)
    base[50:90] = base[50]
    monkeypatch.setattr(knn_module, "FEWEST_AT_ONCE", 7)
    monkeypatch.setattr(knn_module, "STATE_BYTES", 1)
    monkeypatch.setattr(knn_module, "HELD_BYTES", 500)
    sizes, real = spark.sparkContext.accumulator(0), knn_module.Search.block

    def counted(self, qids, vectors, bounds):
        assert len(qids) <= 7
        sizes.add(len(qids))
        return real(self, qids, vectors, bounds)

    monkeypatch.setattr(knn_module.Search, "block", counted)
    frame = vector_frame(spark, range(400), base, shard=[0] * 400)
    found = knn(frame, vector_frame(spark, range(30), qs, "qid"), 6, metric, per=per)
    assert_neighbors(found.drop("shard"), brute_force(range(400), base, range(30), qs, 6, metric))
    assert sizes.value >= 30
