"""Near-duplicate vectors by spherical-cap filters: structured random product codes, joined and verified.

A filter is a direction; a vector passes if its inner product with it exceeds a threshold. Directions are
all combinations of a codeword per half of the dimensions, so the filters that a vector passes can be
listed without testing them all. Filters of one product code depend on each other, so there are several codes, each
behind a random rotation. Close vectors pass common filters with high probability; vectors
that share one are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log, sqrt
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.llm.components import connected_components
from nearfield.operators.ordinals import join_sized
from nearfield.session import cut_lineage

COSINE = 0.93
OCCUPANCY = 16  # vectors of a label that an average filter holds
MISS = 1e-5  # aimed-at share of lost pairs at the threshold
CODES = 4  # product codes with rotations of their own
TOP = 4  # best filters of a code that every vector passes, however weak
DECODE_BYTES = 64 << 20  # working memory of list decoding beside the codewords
CHUNK = 512  # vectors on one side of a comparison


@dataclass(frozen=True)
class Code:
    """Filters for vectors of one length: codewords of a half of each code, and the threshold."""

    dim: int
    words: int
    threshold: float
    seed: int

    def parts(self, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rotation and the codewords of both halves of one of the ``CODES`` codes."""
        rng = np.random.default_rng([self.seed, self.dim, number])
        turn = np.linalg.qr(rng.standard_normal((self.dim, self.dim)))[0]
        out, cut = [turn], max(1, self.dim // 2)
        for size in (cut, self.dim - cut):
            c = rng.standard_normal((self.words, max(size, 1)))
            c /= np.linalg.norm(c, axis=1, keepdims=True) * sqrt(2)
            out.append(c[:, :size])
        return tuple(out)

    def passed(self, unit: np.ndarray) -> Iterator[np.ndarray]:
        """Sorted numbers of the filters that each row of ``unit`` passes; rows are taken in blocks of bounded size."""
        codes = [self.parts(number) for number in range(CODES)]
        step = max(1, DECODE_BYTES // (32 * self.words))  # four matrices of rows x codewords
        for at in range(0, len(unit), step):
            block = unit[at : at + step]
            lists = [self._decode(block @ turn, first, second) for turn, first, second in codes]
            for row in zip(*lists):
                yield np.concatenate([found + number * self.words**2 for number, found in enumerate(row)])

    def _decode(self, unit: np.ndarray, first: np.ndarray, second: np.ndarray) -> list[np.ndarray]:
        s1, s2 = unit[:, : first.shape[1]] @ first.T, unit[:, first.shape[1] :] @ second.T
        o1, o2 = np.argsort(-s1, axis=1, kind="stable"), np.argsort(-s2, axis=1, kind="stable")
        s1, s2 = np.take_along_axis(s1, o1, 1), np.take_along_axis(s2, o2, 1)
        out = []
        for a, b, i, j in zip(s1, s2, o1, o2):
            # Best first: stop at the first codeword that fails even with the best of the other half.
            live = int(np.searchsorted(-a, b[0] - self.threshold, side="right"))
            counts = np.searchsorted(-b, a[:live] - self.threshold, side="right")
            whole = np.repeat(i[:live], counts)
            step = np.arange(len(whole)) - np.repeat(np.cumsum(counts) - counts, counts)
            found = whole.astype(np.int64) * self.words + j[step]
            top = np.add.outer(a[:TOP], b[:TOP])
            best = np.argsort(-top, axis=None, kind="stable")[:TOP]
            best = i[best // top.shape[1]].astype(np.int64) * self.words + j[best % top.shape[1]]
            out.append(np.unique(np.concatenate([found, best])))
        return out


def choose_code(dim: int, most: int, cosine: float, seed: int = 0) -> Code:
    """Threshold and number of filters from the largest label: constant occupancy, recall as aimed at."""
    normal = NormalDist()
    share = min(0.05, OCCUPANCY / max(most, 1))
    level = normal.inv_cdf(1 - share)
    # P(other passes | one passes at the level), for unit normals of correlation ``cosine``
    xs = np.linspace(level, level + 8, 801)
    density = np.exp(-xs * xs / 2)
    tail = np.array([1 - normal.cdf((level - cosine * x) / sqrt(1 - cosine**2)) for x in xs])
    both = float((density * tail).sum() / density.sum())
    filters = -log(MISS) / both / share
    return Code(dim, max(8, int(sqrt(filters / CODES)) + 1), level / sqrt(dim), seed)


def _units(column: pd.Series) -> np.ndarray:
    v = np.stack(column.to_numpy()).astype(np.float64)
    scale = np.abs(v).max(axis=1, keepdims=True)  # keeps squares of extreme values finite
    v = v / scale
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _compare(ids: np.ndarray, weights: np.ndarray, unit: np.ndarray, lists: list[np.ndarray], side: np.ndarray, own: int, cosine: float) -> pd.DataFrame | None:
    """Links of one filter (or of two chunks of it): summed weights, and the smallest node reached.

    ``side``: 0 and 1 for the two chunks, all 2 for one chunk with itself. A pair counts only in the
    first filter that both pass.
    """
    if side[0] == 2:
        near = unit @ unit.T >= cosine
        np.fill_diagonal(near, False)
    else:
        near = np.zeros((len(ids), len(ids)), dtype=bool)
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        near[np.ix_(a, b)] = unit[a] @ unit[b].T >= cosine
        near |= near.T
    if not near.any():
        return None
    earlier = [x[x < own] for x in lists]
    columns, at = np.unique(np.concatenate(earlier), return_inverse=True)
    if len(columns):
        member = np.zeros((len(ids), len(columns)), dtype=np.float32)
        member[np.repeat(np.arange(len(ids)), [len(x) for x in earlier]), at] = 1
        near &= member @ member.T == 0
    if not near.any():
        return None
    label = ids.copy()
    while True:
        reached = np.minimum(label, np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (reached == label).all():
            break
        label = reached
    used = near.any(axis=1)
    return pd.DataFrame({"id": ids[used], "links": (near @ weights)[used], "root": label[used]})


def vector_links(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    seed: int = 0,
) -> DataFrame:
    """One row per vector: ``(key, n_links, component_id, kept)``.

    ``n_links`` counts the other rows of the same label with a cosine of at least ``cosine`` that were
    found (recall is measured in the tests); ``component_id`` is the smallest key reachable over
    links, ``kept`` tells whether it is the row's own. Rows whose label or vector is null, or whose
    vector is empty, zero, or holds a null, NaN or infinity, link with nothing; vectors of different
    lengths are not compared. Equal vectors of a label are one node with a weight, so copies cost
    nothing. Rows with a null key link with nothing either and are kept. An empty table gives an empty result.
    """
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("v"), F.col(label).cast("string").alias("l"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x) == float("inf")))
    good = F.col("id").isNotNull() & F.col("l").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0)
    usable = rows.where(F.coalesce(good, F.lit(False)))
    classes = usable.groupBy("l", "v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("m"))
    classes = cut_lineage(classes, "vectors")
    per = classes.groupBy("l", F.size("v").alias("dim")).count().groupBy("dim").agg(F.max("count").alias("most"))
    codes = {r.dim: choose_code(r.dim, r.most, cosine, seed) for r in per.collect()}  # one per vector length

    def filters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch["v"].map(len)):
                passed = list(codes[dim].passed(_units(part["v"])))
                counts = [len(p) for p in passed]
                at = np.repeat(np.arange(len(part)), counts)
                out = part.iloc[at][["l", "id", "m", "v"]].assign(
                    f=np.concatenate(passed), fs=[passed[i] for i in at.tolist()], dim=dim
                )
                for start in range(0, len(out), 20_000):
                    yield out.iloc[start : start + 20_000]

    kind = vectors.schema[vector].dataType.simpleString()
    spread = classes.mapInPandas(filters, f"l string, id long, m long, v {kind}, f long, fs array<long>, dim int")
    spread = cut_lineage(spread, "filters")
    sizes = spread.groupBy("l", "dim", "f").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    shared = join_sized(spread, sizes, ["l", "dim", "f"]).withColumn("chunks", chunks)
    shared = shared.withColumn("c", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    shared = shared.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
    shared = shared.select(
        "l", "dim", "f", "id", "m", "v", "fs",
        F.least("c", "other").alias("i"), F.greatest("c", "other").alias("j"),
        F.expr("IF(c = other, 2, IF(c < other, 0, 1))").alias("side"),
    )
    group = ["l", "dim", "f", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; the last group of a batch waits for the next one."""
        held = None
        found: list[pd.DataFrame] = []

        def work(part: pd.DataFrame) -> None:
            for _, g in part.groupby(group, sort=False):
                if len(g) > 1:
                    out = _compare(
                        g["id"].to_numpy(), g["m"].to_numpy(), _units(g["v"]), list(g["fs"]), g["side"].to_numpy(), g["f"].iloc[0], cosine
                    )
                    if out is not None:
                        found.append(out)

        def batch_of(frames: list[pd.DataFrame]) -> pa.RecordBatch:
            out = pa.RecordBatch.from_pandas(pd.concat(frames), preserve_index=False)
            frames.clear()
            return out

        for batch in batches:
            part = batch.to_pandas()
            part = part if held is None else pd.concat([held, part], ignore_index=True)
            last = part[group].iloc[-1]
            tail = (part[group] == last).all(axis=1)
            held = part[tail]
            work(part[~tail])
            if sum(map(len, found)) > 50_000:
                yield batch_of(found)
        if held is not None:
            work(held)
        if found:
            yield batch_of(found)

    links = shared.repartition(*[F.col(c) for c in group]).sortWithinPartitions(*group)
    links = cut_lineage(links.mapInArrow(compare, "id long, links long, root long"), "links")
    counts = links.groupBy("id").agg(F.sum("links").alias("links"))
    parts = connected_components(links.selectExpr("id a", "root b"))
    nodes = classes.join(counts, "id", "left").join(parts, "id", "left")
    nodes = nodes.select(
        "l", "v", "m", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("component")
    )
    linked = usable.join(nodes, ["l", "v"]).select("id", (F.col("links") + F.col("m") - 1).alias("links"), "component")
    alone = rows.where(~F.coalesce(good, F.lit(False))).select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    return linked.unionByName(alone).select(
        F.col("id").alias(key),
        F.col("links").alias("n_links"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )
