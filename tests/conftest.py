from __future__ import annotations

import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from nearfield.session import local_session, ship_with_tasks  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ship_with_tasks()
    session = local_session("tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rng():
    return np.random.default_rng(11)


def vector_frame(spark, ids, matrix, id_name="pk", **extra):
    """Vector table from arrays, over several partitions."""
    names = list(extra)
    rows = [
        (int(i), [float(x) for x in v], *(extra[n][at] for n in names))
        for at, (i, v) in enumerate(zip(ids, np.asarray(matrix, dtype=np.float32)))
    ]
    ddl = f"{id_name} long, vector array<float>" + "".join(f", {n} long" for n in names)
    return spark.createDataFrame(rows, ddl).repartition(5, id_name)


def brute_force(base_ids, base, query_ids, queries, k, metric, normalize_base=False):
    """All pairs in double precision: {(qid, rank): (id, distance)}."""
    x, q = np.asarray(base, np.float32).astype(float), np.asarray(queries, np.float32).astype(float)

    def unit(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(n == 0, 1, n)

    if normalize_base:
        x = unit(x)
    if metric == "l2":
        d = ((q[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    else:
        d = unit(q) @ unit(x).T
        if metric == "cosine_distance":
            d = 1 - d
    sign = -1 if metric == "cosine" else 1
    out = {}
    for row, qid in enumerate(query_ids):
        order = sorted(range(len(base_ids)), key=lambda j: (round(sign * d[row, j], 12), base_ids[j]))
        for rank, j in enumerate(order[:k], 1):
            out[int(qid), rank] = (int(base_ids[j]), float(d[row, j]))
    return out


def assert_neighbors(found, expected):
    rows = {(r.qid, r.rank): (r.id, r.distance) for r in found.collect()}
    assert rows.keys() == expected.keys()
    for key, (i, d) in expected.items():
        assert rows[key][0] == i, (key, rows[key], expected[key])
        assert abs(rows[key][1] - d) < 1e-9 * max(1.0, abs(d))
