"""Block distance kernel that runs inside Spark tasks.

Ranking uses single-precision matrix products. Their rounding error is bounded, so every row
that could belong to the top k passes the filter; the rows still left when a task ends are then
measured exactly in double precision. Results therefore do not depend on block sizes or on the
matrix library.

Scores are internal and always "smaller is better"; similarities are negated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

HALF_ULP = float(np.finfo(np.float32).eps) / 2
CHUNK_BYTES = 1 << 21  # double-precision rows measured at once: what a core's cache holds
ROWS_OUT = 1 << 16
KEPT_BYTES = 128 << 20  # base vectors a task keeps for the exact pass


def to_matrix(col: pa.Array) -> np.ndarray:
    """List column to a float32 matrix; NULLs, ragged rows and non-finite values are errors."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        raise ValueError("NULL vector")
    n = len(col)
    values = col.flatten()
    if values.null_count:
        raise ValueError("NULL vector element")
    widths = np.diff(col.offsets.to_numpy())
    if n and (widths != widths[0]).any():
        raise ValueError("vectors of different dimensions")
    m = values.to_numpy(zero_copy_only=False).astype(np.float32, copy=False)
    m = m.reshape(n, int(widths[0]) if n else 0)
    if not np.isfinite(m).all():
        raise ValueError("NaN or infinite vector element")
    return m


def row_norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", m, m, dtype=np.float64))


def _at_least(limit: np.ndarray, dtype) -> np.ndarray:
    """``limit`` in ``dtype``, rounded up."""
    return np.nextafter(limit.astype(dtype), dtype(np.inf))


def _without_surplus_copies(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray | None:
    """Rows to keep so that each distinct vector stays with its k smallest ids; None keeps all.

    Copies score alike for every query, so further ones cannot be in any answer.
    """
    _, group, sizes = np.unique(row_norms(vectors), return_inverse=True, return_counts=True)
    if sizes.max() <= k:
        return None
    suspects = np.nonzero(sizes[group] > k)[0]
    keep = np.ones(len(ids), dtype=bool)
    ordered = suspects[np.argsort(ids[suspects], kind="stable")]
    rows = np.ascontiguousarray(vectors[ordered])
    if rows.shape[1]:
        _, group = np.unique(rows.view(f"V{rows.shape[1] * rows.itemsize}").ravel(), return_inverse=True)
    else:
        group = np.zeros(len(rows), dtype=np.int64)
    by = np.argsort(group, kind="stable")  # copies side by side, still by id
    first = np.flatnonzero(np.append(True, np.diff(group[by]) != 0))
    place = np.arange(len(by)) - np.repeat(first, np.diff(np.append(first, len(by))))
    keep[ordered[by[place >= k]]] = False
    return keep


def _sort_bits(scores: np.ndarray) -> np.ndarray:
    """float32 scores, rounded up, as integers in the same order."""
    with np.errstate(over="ignore"):
        up = np.nextafter(scores.astype(np.float32), np.float32(np.inf)) + np.float32(0)
    bits = up.view(np.uint32)
    return np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))


def _from_sort_bits(bits: np.ndarray) -> np.ndarray:
    bits = bits.astype(np.uint32)
    return np.where(bits >> 31, bits & np.uint32(0x7FFFFFFF), ~bits).view(np.float32)


class Side:
    """Vectors of one side of the comparison, ready for ranking and for exact measuring."""

    def __init__(self, raw: np.ndarray, metric: str, normalize: bool):
        norms = row_norms(raw)
        self.raw = raw
        self.divisor = None
        if normalize or metric != "l2":
            self.divisor = np.where(norms == 0, 1.0, norms)
            self.norms = np.where(norms == 0, 0.0, 1.0)
        else:
            self.norms = norms

    def exact(self, rows) -> np.ndarray:
        m = self.raw[rows].astype(np.float64)
        if self.divisor is not None:
            m /= self.divisor[rows, None]
        return m

    def ranking(self, dtype, lo: int = 0, hi: int | None = None) -> np.ndarray:
        m = self.raw[lo:hi]
        if self.divisor is None:
            return m.astype(dtype, copy=False)
        return (m / self.divisor[lo:hi, None]).astype(dtype)


class QueryBlock:
    """A bounded set of queries and the best k rows seen so far for each of them.

    Candidates wait as (query, score interval, kept vector). They are thinned by their intervals
    as they grow in number, and measured exactly when thinning no longer helps (many equal
    distances), when the kept vectors fill up, or at the end.
    """

    def __init__(self, qids, vectors, bounds, k, metric, normalize_query, rows_per_block):
        self.qids = np.asarray(qids, dtype=np.int64)
        self.side = Side(vectors, metric, normalize_query)
        self.k = k
        self.metric = metric
        self.rows_per_block = rows_per_block
        n = len(self.qids)
        # No row above its query's bound can be in the answer.
        self.bounds = np.full(n, np.inf) if bounds is None else np.array(bounds, dtype=np.float64)
        self.q = np.empty(0, np.int32)
        self.ids = np.empty(0, np.int64)
        self.scores = np.empty(0, np.float64)
        self.ranking_cache: dict[tuple[int, type], np.ndarray] = {}
        self.thin_at = max(2 * k * n, 1 << 16)
        self._release()

    def _release(self):
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_waiting = 0
        self.kept: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_kept = 0

    def _ranking(self, lo, hi, dtype):
        key = (lo, dtype)
        if key not in self.ranking_cache:
            self.ranking_cache[key] = self.side.ranking(dtype, lo, hi)
        return self.ranking_cache[key]

    def add(self, ids: np.ndarray, vectors: np.ndarray, normalize_base: bool) -> None:
        """Offer a batch of base rows."""
        if not len(ids) or not len(self.qids):
            return
        if vectors.shape[1] != self.side.raw.shape[1]:
            raise ValueError(
                f"base dimension {vectors.shape[1]}, query dimension {self.side.raw.shape[1]}"
            )
        self.normalize_base = normalize_base
        keep = _without_surplus_copies(ids, vectors, self.k)
        if keep is not None:
            ids, vectors = ids[keep], vectors[keep]
        base = Side(vectors, self.metric, normalize_base)
        widest = base.norms.max()
        peak = max(widest, self.side.norms.max())
        dtype = np.float32 if peak < 1e18 else np.float64
        x = base.ranking(dtype)
        x_sq = (base.norms**2).astype(dtype)
        dim = x.shape[1]
        spots = np.full(len(ids), -1)
        for lo in range(0, len(self.qids), self.rows_per_block):
            hi = min(lo + self.rows_per_block, len(self.qids))
            rough = self._ranking(lo, hi, dtype) @ x.T
            q_norms = self.side.norms[lo:hi]
            if self.metric == "l2":
                rough *= -2
                rough += x_sq
                rough += (q_norms**2).astype(dtype)[:, None]
            else:
                np.negative(rough, out=rough)
                if self.metric == "cosine_distance":
                    rough += 1
            # |rough - true| <= slack, from the standard bound on a length-dim dot product.
            reach = q_norms + widest if self.metric == "l2" else np.full(hi - lo, 2.0)
            slack = (dim + 8) * HALF_ULP * reach**2 + dim * float(np.finfo(np.float32).tiny)
            limit = self.bounds[lo:hi] + slack
            mask = rough <= _at_least(limit, dtype)[:, None]
            if x.shape[0] > self.k and np.count_nonzero(mask) > 2 * self.k * (hi - lo):
                kth = np.partition(rough, self.k - 1, axis=1)[:, self.k - 1].astype(np.float64)
                mask = rough <= _at_least(np.minimum(limit, kth + 2 * slack), dtype)[:, None]
            rows, cols = np.nonzero(mask)
            if len(rows):
                self._wait(rows + lo, cols, rough[rows, cols].astype(np.float64), slack[rows], ids, vectors, spots)

    def _wait(self, q, cols, rough, slack, ids, vectors, spots):
        """Queue candidates; ``spots`` says where a batch row's vector is kept already."""
        fresh = np.unique(cols[spots[cols] < 0])
        if len(fresh):
            spots[fresh] = self.n_kept + np.arange(len(fresh))
            self.kept.append((ids[fresh], vectors[fresh]))
            self.n_kept += len(fresh)
        key = (q.astype(np.uint64) << np.uint64(32)) | _sort_bits(rough + slack)
        with np.errstate(over="ignore"):
            low = np.nextafter((rough - slack).astype(np.float32), np.float32(-np.inf))
        self.waiting.append((key, low, spots[cols].astype(np.int32)))
        self.n_waiting += len(key)
        full = self.n_kept * 4 * vectors.shape[1] >= KEPT_BYTES
        if self.n_waiting >= self.thin_at:
            self._thin()
            full = full or self.n_waiting > self.thin_at * 3 // 4
        if full:
            self._settle()
            spots[:] = -1

    def _thin(self):
        """Drop candidates whose interval lies above the k-th interval's end."""
        key, low, spot = (np.concatenate(part) for part in zip(*self.waiting))
        self.waiting = []
        order = np.argsort(key)
        key = key[order]
        q = _query_of(key)
        last = _places(q, len(self.qids)) == self.k - 1
        ends = _from_sort_bits(key[last] & np.uint64(0xFFFFFFFF))
        self.bounds[q[last]] = np.minimum(self.bounds[q[last]], ends)
        keep = low[order] <= self.bounds[q]
        order = order[keep]
        self.waiting = [(key[keep], low[order], spot[order])]
        self.n_waiting = len(order)

    def _settle(self):
        """Measure the waiting rows and keep the best k of all, ties by id."""
        if not self.waiting:
            return
        self._thin()
        key, _, spot = self.waiting[0]
        ids, vectors = (np.concatenate(part) for part in zip(*self.kept))
        self._release()
        base = Side(vectors, self.metric, self.normalize_base)
        q = _query_of(key)
        scores = np.concatenate([self.scores, self._measure(q, base, spot)])
        q = np.concatenate([self.q, q])
        ids = np.concatenate([self.ids, ids[spot]])
        del key, spot, base, vectors
        order = np.lexsort((ids, scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        place = _places(q, len(self.qids))
        last, keep = place == self.k - 1, place < self.k
        self.bounds[q[last]] = np.minimum(self.bounds[q[last]], scores[last])
        self.q, self.ids, self.scores = q[keep], ids[keep], scores[keep]

    def _measure(self, q: np.ndarray, base: Side, spot: np.ndarray) -> np.ndarray:
        """Exact scores of (query, kept row) pairs that come grouped by query."""
        out = np.empty(len(q))
        step = max(64, CHUNK_BYTES // (8 * base.raw.shape[1] + 1))
        if len(q) >= 32 * len(self.qids):  # long groups: one query against its rows at a time
            edges = np.searchsorted(q, np.arange(len(self.qids) + 1))
            steps = [
                (slice(at, min(at + step, hi)), slice(i, i + 1))
                for i, (lo, hi) in enumerate(zip(edges, edges[1:]))
                for at in range(lo, hi, step)
            ]
        else:
            steps = [
                (slice(at, at + step), q[at : at + step]) for at in range(0, len(q), step)
            ]
        for part, rows in steps:
            b, a = base.exact(spot[part]), self.side.exact(rows)
            if self.metric == "l2":
                b -= a
                out[part] = np.multiply(b, b, out=b).sum(axis=1)
            else:
                cos = np.clip(np.multiply(b, a, out=b).sum(axis=1), -1.0, 1.0)
                out[part] = -cos if self.metric == "cosine" else 1.0 - cos
        return out

    def results(self):
        """Record batches of (qid, id, distance)."""
        self._settle()
        distance = -self.scores if self.metric == "cosine" else self.scores
        if self.metric == "cosine_distance":
            distance = np.maximum(distance, 0.0)
        for at in range(0, len(self.q), ROWS_OUT):
            part = slice(at, at + ROWS_OUT)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(self.qids[self.q[part]]),
                    pa.array(self.ids[part]),
                    pa.array(distance[part]),
                ],
                names=["qid", "id", "distance"],
            )


def _query_of(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(32)).astype(np.int32)


def _places(q: np.ndarray, n: int) -> np.ndarray:
    """Position of every entry inside its group; ``q`` is sorted."""
    starts = np.searchsorted(q, np.arange(n, dtype=np.int32)).astype(np.int32)
    return np.arange(len(q), dtype=np.int32) - starts[q]
