import numpy as np
import pytest
from conftest import vector_frame

from nearfield.functions.metrics import (
    cosine_distance,
    cosine_similarity,
    l2_normalize,
    l2_sq,
    round_vector,
)
from nearfield.operators.latency import latency_stats
from nearfield.operators.recall import recall, recall_diff, recall_per_query
from nearfield.operators.sampling import sample_queries
from nearfield.sources.tables import scan_latency, write_latency


def lists(spark, table):
    rows = [(q, n, i, 0.0) for q, ids in table.items() for n, i in enumerate(ids, 1)]
    return spark.createDataFrame(rows, "qid long, rank int, id long, distance double")


def asked(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "qid long")


def test_recall(spark):
    truth = lists(spark, {1: [1, 2, 3, 4], 2: [5, 6, 7, 8]})
    result = lists(spark, {1: [1, 2, 9, 10], 2: [5, 6, 7, 7]})
    per = {r.qid: (r.n_result, r.n_found, r.recall) for r in recall_per_query(truth, result, asked(spark, 1, 2)).collect()}
    assert per == {1: (4, 2, 0.5), 2: (4, 3, 0.75)}  # a repeated id counts once as found
    r = recall(truth, result, asked(spark, 1, 2)).first()
    assert (r.n_queries, r.recall) == (2, 0.625)
    assert recall(truth, truth, asked(spark, 1, 2)).first().recall == 1.0
    assert recall(truth, result, asked(spark, 1, 2), k=2).first().recall == 1.0
    assert recall(truth, result, asked(spark, 1)).first().recall == 0.5
    assert {(r.qid, r.id) for r in recall_diff(truth, result).collect()} == {(1, 9), (1, 10)}


def test_empty_result_list_is_an_error(spark):
    truth = lists(spark, {1: [1], 2: [2]})
    with pytest.raises(Exception, match="no result for query 2"):
        recall(truth, lists(spark, {1: [1]}), asked(spark, 1, 2)).collect()


@pytest.mark.parametrize("n", [1, 2, 7, 200])
def test_latency_equals_numpy(spark, n):
    values = np.round(np.random.default_rng(n).exponential(20, n), 3)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "seq long, cost_ms double")
    for first in (None, 5):
        used = values if first is None else values[:first]
        r = latency_stats(df, first_n=first).first()
        assert r.n == len(used)
        np.testing.assert_allclose(
            [r.avg, r.sum, r.min, r.max, r.p50, r.p95, r.p99],
            [used.mean(), used.sum(), used.min(), used.max(), *np.percentile(used, [50, 95, 99])],
            rtol=1e-12,
        )


def test_latency_of_groups_with_one_hot_value(spark):
    rows = [("a", 5.0)] * 90 + [("a", float(i)) for i in range(30)] + [(None, 1.0), ("b", -2.5)]
    df = spark.createDataFrame(rows, "kind string, cost_ms double")
    out = {r.kind: r for r in latency_stats(df, by=["kind"]).collect()}
    a = np.array([v for k, v in rows if k == "a"])
    np.testing.assert_allclose([out["a"].p50, out["a"].p95, out["a"].p99], np.percentile(a, [50, 95, 99]))
    assert out[None].p99 == 1.0 and out["b"].p50 == -2.5


def test_latency_file_round_trip(spark, tmp_path):
    values = [3.25, 1.5, 2.0, 9.75, 0.5] * 40
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "seq long, cost_ms double")
    write_latency(df.repartition(5), str(tmp_path / "lat"))
    back = scan_latency(spark, str(tmp_path / "lat")).orderBy("seq").collect()
    assert [r.cost_ms for r in back] == values
    (tmp_path / "one.txt").write_text("".join(f"{v:.18e}\n" for v in values))
    assert [r.cost_ms for r in scan_latency(spark, str(tmp_path / "one.txt")).orderBy("seq").collect()] == values


def test_sampling(spark):
    df = spark.range(400).selectExpr("id pk", "id % 8 shard_no")
    a = sample_queries(df, 3, 20, seed=1)
    rows = a.collect()
    assert len(rows) == 18 and len({r.shard_no for r in rows}) == 3 and len({r.pk for r in rows}) == 18
    assert set(sample_queries(df.repartition(7), 3, 20, seed=1).collect()) == set(rows)
    assert set(sample_queries(df, 3, 20, seed=2).collect()) != set(rows)
    many = spark.range(130).selectExpr("id shard_no", "id pk")  # no shard is left out by default
    assert sample_queries(many, 130, 130).count() == 130
    early = sample_queries(df, 2, 10, seed=1, first_shards=2).collect()
    assert {r.shard_no for r in early} == {0, 1}


def test_sampling_needs_enough_rows(spark):
    df = spark.range(40).selectExpr("id pk", "id % 8 shard_no")
    with pytest.raises(Exception, match="too few rows"):
        sample_queries(df, 2, 20).collect()
    with pytest.raises(Exception, match="fewer shards"):
        sample_queries(df, 20, 20)
    with pytest.raises(Exception, match="fewer shards"):
        sample_queries(df.where("pk < 0"), 1, 1)
    with pytest.raises(ValueError):
        sample_queries(df, 5, 4)


def test_column_metrics(spark, rng):
    a, b = rng.normal(size=(20, 7)), rng.normal(size=(20, 7))
    a[3] = 0
    df = vector_frame(spark, range(20), a).withColumnRenamed("vector", "a").join(
        vector_frame(spark, range(20), b).withColumnRenamed("vector", "b"), "pk"
    )
    rows = df.select(
        "pk", l2_sq("a", "b").alias("l2"), cosine_similarity("a", "b").alias("cos"),
        cosine_distance("a", "b").alias("dist"), l2_normalize("a").alias("unit"),
        round_vector("a", 3).alias("short"),
    ).collect()
    for r in rows:
        x, y = a[r.pk].astype(np.float32).astype(float), b[r.pk].astype(np.float32).astype(float)
        nx = np.linalg.norm(x)
        cos = 0.0 if nx == 0 else x @ y / (nx * np.linalg.norm(y))
        np.testing.assert_allclose([r.l2, r.cos, r.dist], [((x - y) ** 2).sum(), cos, 1 - cos], atol=1e-12)
        np.testing.assert_allclose(r.unit, x / (nx or 1), atol=1e-12)
        np.testing.assert_allclose(r.short, x, atol=6e-4)
