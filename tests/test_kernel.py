"""The task kernel on its own, in batches."""

import numpy as np
import pytest

from nearfield.operators import kernel
from nearfield.operators.kernel import QueryBlock


def exact(base, qs):
    return ((qs[:, None, :].astype(float) - base[None, :, :].astype(float)) ** 2).sum(axis=2)


def answer(ids, d, k):
    return {
        (q, int(ids[j])) for q in range(len(d)) for j in sorted(range(len(ids)), key=lambda j: (d[q, j], ids[j]))[:k]
    }


def run(base, ids, qs, k, batch, block=7, bounds=None):
    held = QueryBlock(np.arange(len(qs)), qs, bounds, k, "l2", False, block)
    for at in range(0, len(ids), batch):
        held.add(ids[at : at + batch], base[at : at + batch], False)
    out = set()
    for b in held.results():
        out |= set(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
    return out, held


@pytest.mark.parametrize("k", [1, 5, 64, 500])
@pytest.mark.parametrize("batch", [13, 200, 1000])
def test_batches_do_not_matter(rng, k, batch):
    base, qs = rng.normal(size=(600, 9)).astype(np.float32), rng.normal(size=(20, 9)).astype(np.float32)
    ids = rng.permutation(600).astype(np.int64)
    assert run(base, ids, qs, k, batch)[0] == answer(ids, exact(base, qs), k)


@pytest.mark.parametrize("thin_at, kept", [(50, 1 << 27), (1 << 20, 2000), (50, 500)])
def test_early_thinning_and_settling(rng, monkeypatch, thin_at, kept):
    monkeypatch.setattr(kernel, "KEPT_BYTES", kept)
    base, qs = rng.normal(size=(500, 6)).astype(np.float32), rng.normal(size=(11, 6)).astype(np.float32)
    ids = rng.permutation(500).astype(np.int64)
    held = QueryBlock(np.arange(11), qs, None, 8, "l2", False, 4)
    held.thin_at = thin_at
    for at in range(0, 500, 60):
        held.add(ids[at : at + 60], base[at : at + 60], False)
    found = {(q, i) for b in held.results() for q, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    assert found == answer(ids, exact(base, qs), 8)


def test_copies_do_not_pile_up(rng):
    """A third of the rows are one vector, spread over all batches."""
    base = rng.normal(size=(6000, 4)).astype(np.float32)
    base[rng.permutation(6000)[:2000]] = base[17]
    ids = rng.permutation(6000).astype(np.int64)
    qs = np.vstack([base[17], base[17] + np.float32(1e-4), base[:8]])
    held = QueryBlock(np.arange(10), qs, None, 5, "l2", False, 512)
    most = 0
    for at in range(0, 6000, 500):
        held.add(ids[at : at + 500], base[at : at + 500], False)
        most = max(most, held.n_waiting)
    found = {(q, i) for b in held.results() for q, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    assert found == answer(ids, exact(base, qs), 5)
    assert most < 12 * 10 * 5 * 3


def test_all_rows_equally_far(rng):
    """Different vectors, one distance: intervals cannot separate them, ids must."""
    base = np.eye(64, dtype=np.float32)[rng.integers(0, 64, 5000)]
    base[np.arange(5000), rng.integers(0, 64, 5000)] *= -1
    qs = np.zeros((6, 64), np.float32)
    ids = rng.permutation(5000).astype(np.int64)
    held = QueryBlock(np.arange(6), qs, None, 3, "l2", False, 512)
    held.thin_at = 200
    for at in range(0, 5000, 1000):
        held.add(ids[at : at + 1000], base[at : at + 1000], False)
        assert held.n_waiting <= 200
    found = {(q, i) for b in held.results() for q, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    assert found == answer(ids, exact(base, qs), 3)


def test_bounds_only_prune(rng):
    base, qs = rng.normal(size=(400, 5)).astype(np.float32), rng.normal(size=(9, 5)).astype(np.float32)
    ids = np.arange(400)
    d = exact(base, qs)
    kth = np.sort(d, axis=1)[:, 6]
    assert run(base, ids, qs, 7, 50, bounds=kth)[0] == answer(ids, d, 7)


def test_sort_bits_keep_the_order(rng):
    x = np.sort(np.concatenate([rng.normal(size=100) * 10.0 ** rng.integers(-20, 20, 100), [0.0, -0.0, 1e39, -1e39]]))
    bits = kernel._sort_bits(x)
    assert (np.diff(bits.astype(np.int64)) >= 0).all()
    assert (kernel._from_sort_bits(bits) >= x).all()
