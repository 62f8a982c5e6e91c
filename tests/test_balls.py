import numpy as np
import pytest
from conftest import assert_neighbors, brute_force, vector_frame
from pyspark.sql import functions as F

from nearfield.functions.metrics import get_metric
from nearfield.operators import balls
from nearfield.operators.balls import BallTable, knn_balls, needed_blocks, write_balls
from nearfield.operators.knn import Search


def clustered(rng, n, dim=6, centres=12):
    return (rng.normal(scale=20, size=(centres, dim))[rng.integers(0, centres, n)] + rng.normal(size=(n, dim))).astype(np.float32)


@pytest.mark.parametrize("block_rows", [16, 100, 5000])
def test_equal_to_brute_force(spark, tmp_path, rng, block_rows):
    base, qs = clustered(rng, 900), clustered(rng, 12)
    base[300:500] = base[0]  # copies fill whole blocks
    table = write_balls(vector_frame(spark, range(900), base), str(tmp_path / "t"), block_rows=block_rows)
    found = knn_balls(table, vector_frame(spark, range(12), qs, "qid"), 7)
    assert_neighbors(found, brute_force(range(900), base, range(12), qs, 7, "l2"))
    copies = vector_frame(spark, [0], base[:1], "qid")
    assert_neighbors(knn_balls(table, copies, 250), brute_force(range(900), base, [0], base[:1], 250, "l2"))


def test_balls_hold_their_rows(spark, tmp_path, rng):
    base = clustered(rng, 700)
    table = write_balls(vector_frame(spark, range(700), base), str(tmp_path / "t"), block_rows=50)
    rows = table.balls(spark).collect()
    assert sorted(r.block for r in rows) == list(range(len(rows))) and sum(r.n_rows for r in rows) == 700
    assert max(r.n_rows for r in rows) <= 50
    seen = []
    for r in rows:
        part = balls.pq.ParquetFile(r.path).read_row_group(r.row_group)
        m = np.array(part["vector"].to_pylist())
        seen += part["id"].to_pylist()
        assert (np.linalg.norm(m - np.array(r.centre), axis=1) <= r.radius).all()
    assert sorted(seen) == list(range(700)) == sorted(r.id for r in table.scan(spark).collect())


def test_blocks_are_skipped(spark, tmp_path, rng):
    """In well parted data most blocks are asked for by no query, and each by few."""
    base = clustered(rng, 4000, centres=40)
    table = write_balls(vector_frame(spark, range(4000), base), str(tmp_path / "t"), block_rows=50)
    q = vector_frame(spark, range(3), base[:3], "qid")
    truth = brute_force(range(4000), base, range(3), base[:3], 5, "l2")
    bounds = spark.createDataFrame([(i, truth[i, 5][1]) for i in range(3)], "qid long, bound double")
    plan = Search(5, get_metric("l2"), False, False, 512, 3, 6, None, 1 << 20, 1 << 30)
    needed = needed_blocks(table.balls(spark), q.join(bounds, "qid"), plan)
    total = table.balls(spark).count()
    assert total >= 80 and needed.count() < total / 5
    assert_neighbors(knn_balls(table, q, 5), truth)
    nothing = needed_blocks(table.balls(spark), q.withColumn("bound", F.lit(None).cast("double")), plan)
    assert nothing.count() == total  # without a bound nothing may be skipped


def test_small_tables_and_large_query_sets(spark, tmp_path, rng):
    base = clustered(rng, 30)
    table = write_balls(vector_frame(spark, range(30), base), str(tmp_path / "t"), block_rows=8)
    q = vector_frame(spark, range(4), base[:4], "qid")
    truth = brute_force(range(30), base, range(4), base[:4], 50, "l2")
    assert_neighbors(knn_balls(table, q, 50), truth)
    assert_neighbors(knn_balls(table, q, 50, broadcast_bytes=1), truth)
    assert knn_balls(table, q.limit(0), 5).count() == 0
    none = write_balls(vector_frame(spark, [], np.zeros((0, 3))), str(tmp_path / "n"))
    assert knn_balls(BallTable(none.path, none.n_rows, none.dim), q, 5).count() == 0


def test_lists_of_asking_queries_are_bounded(spark, tmp_path, rng, monkeypatch):
    """A block that many queries ask for has several rows of few queries each; the answer stays."""
    monkeypatch.setattr(balls, "ASKED", 4)
    monkeypatch.setattr(balls, "QUERIES_AT_ONCE", 5)
    base = clustered(rng, 300)
    table = write_balls(vector_frame(spark, range(300), base), str(tmp_path / "t"), block_rows=20)
    q = vector_frame(spark, range(30), base[:30], "qid")
    plan = Search(5, get_metric("l2"), False, False, 512, 30, 6, None, 1 << 20, 1 << 30)
    needed = needed_blocks(table.balls(spark), q.withColumn("bound", F.lit(None).cast("double")), plan).collect()
    total = table.balls(spark).count()
    assert max(len(r.qids) for r in needed) <= 4 and len(needed) == 8 * total
    assert len({(r.block, i) for r in needed for i in r.qids}) == 30 * total
    assert_neighbors(knn_balls(table, q, 5), brute_force(range(300), base, range(30), base[:30], 5, "l2"))
