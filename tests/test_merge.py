"""Merging partial lists: any split gives the result of the whole."""

import numpy as np
import pytest
from conftest import vector_frame
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from nearfield.operators.knn import knn
from nearfield.operators.topk import merge_topk, to_long, to_wide, top_k

NEIGHBORS = "qid long, rank int, id long, distance double"


def rows(df):
    return sorted((r.qid, r.rank, r.id, r.distance) for r in df.collect())


def lists(spark, *entries):
    return spark.createDataFrame([(q, 0, i, d) for q, i, d in entries], NEIGHBORS)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_sharding_invariance(spark, rng, metric):
    base, qs = rng.normal(size=(150, 6)), rng.normal(size=(9, 6))
    q = vector_frame(spark, range(9), qs, "qid")
    whole = knn(vector_frame(spark, range(150), base), q, 8, metric)
    cuts = [0, 3, 40, 41, 150]
    parts = [
        knn(vector_frame(spark, range(a, b), base[a:b]), q, 8, metric)
        for a, b in zip(cuts, cuts[1:])
    ]
    merged = merge_topk(*parts, k=8, metric=metric)
    assert rows(merged) == rows(whole)
    left = merge_topk(merge_topk(parts[3], parts[0], k=8, metric=metric), parts[2], parts[1], k=8, metric=metric)
    assert rows(left) == rows(whole)
    again = merge_topk(*parts, *parts, k=8, metric=metric, distinct_ids=True)
    assert rows(again) == rows(whole)


def test_direction_follows_the_metric(spark):
    part = lists(spark, (1, 10, 0.2), (1, 11, 0.9), (1, 12, 0.5))
    assert [r[2] for r in rows(merge_topk(part, k=2, metric="cosine"))] == [11, 12]
    assert [r[2] for r in rows(merge_topk(part, k=2, metric="l2"))] == [10, 12]


def test_single_part_is_sorted_and_cut(spark):
    part = lists(spark, (1, 3, 3.0), (1, 2, 1.0), (1, 1, 2.0))
    assert rows(merge_topk(part, k=2, metric="l2")) == [(1, 1, 2, 1.0), (1, 2, 1, 2.0)]


def test_ties_by_id_and_duplicates(spark):
    a, b = lists(spark, (1, 9, 1.0), (1, 4, 1.0)), lists(spark, (1, 4, 1.0), (1, 6, 1.0))
    assert [r[2] for r in rows(merge_topk(a, b, k=3, metric="l2"))] == [4, 4, 6]
    assert [r[2] for r in rows(merge_topk(a, b, k=3, metric="l2", distinct_ids=True))] == [4, 6, 9]


def test_empty_parts(spark):
    empty = lists(spark, (1, 1, 1.0)).where("qid < 0")
    assert rows(merge_topk(empty, k=3, metric="l2")) == []
    with pytest.raises(ValueError):
        merge_topk(k=3, metric="l2")


def test_one_query_holding_most_rows(spark):
    hot = spark.range(20_000).selectExpr("1L qid", "0 rank", "id", "cast((id * 7919) % 20000 as double) distance")
    cold = spark.range(50).selectExpr("id + 2 qid", "0 rank", "id", "1.0D distance")
    found = merge_topk(hot, cold, k=5, metric="l2").where("qid = 1").orderBy("rank").collect()
    assert [r.distance for r in found] == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_tasks_trim_before_the_shuffle(spark):
    pairs = spark.range(1000).selectExpr("id % 3 qid", "id", "rand(1) distance")
    df = top_k(pairs, 4, "l2")
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert text.count("WindowGroupLimit") == 4


def test_wide_and_long(spark, rng):
    q = vector_frame(spark, range(4), rng.normal(size=(4, 5)), "qid")
    long = knn(vector_frame(spark, range(30), rng.normal(size=(30, 5))), q, 6, "l2")
    wide = to_wide(long)
    assert wide.columns == ["id", "neighbors_id", "distance"]
    assert all(len(r.neighbors_id) == len(r.distance) == 6 for r in wide.collect())
    assert rows(to_long(wide)) == rows(long)
    assert rows(to_long(to_wide(long, 2))) == [r for r in rows(long) if r[1] <= 2]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    entries=st.lists(
        st.tuples(st.integers(0, 2), st.integers(0, 30), st.integers(0, 4).map(float)),
        min_size=1, max_size=40,
    ),
    k=st.integers(1, 6),
)
def test_merge_equals_sorting(spark, entries, k):
    found = rows(merge_topk(lists(spark, *entries), k=k, metric="l2"))
    expected = []
    for q in {e[0] for e in entries}:
        best = sorted((d, i) for x, i, d in entries if x == q)[:k]
        expected += [(q, n, i, d) for n, (d, i) in enumerate(best, 1)]
    assert found == sorted(expected)
    assert np.all([r[1] <= k for r in found])
