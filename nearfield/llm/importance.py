"""Importance resampling towards a target distribution over hashed word n-grams.

Features are the words and neighbouring word pairs of a text, hashed into buckets by CRC-32. A bucket's gain is the
logarithm of its share in the target over its share in the raw texts, in thousandths; a text weighs the
mean gain of its features. The highest weights, after Gumbel noise, are drawn.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.llm.crcmatrix import crc32_all
from nearfield.llm.terms import Terms
from nearfield.llm.words import slices
from nearfield.operators.ordinals import with_ordinal
from nearfield.session import cut_lineage

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25


class _Features:
    """Distinct features of a slice of texts, their buckets, and where each occurs."""

    def __init__(self, column: pa.Array, buckets: int):
        self.terms = terms = Terms(column)
        self.word = terms.ids
        inside = np.ones(max(0, len(terms) - 1), dtype=bool)
        borders = terms.first[(terms.first > 0) & (terms.first < len(terms))]
        inside[borders - 1] = False
        self.left = np.flatnonzero(inside)
        n = max(1, len(terms.distinct))
        coded = pa.array(terms.ids[self.left] * n + terms.ids[self.left + 1]).dictionary_encode()
        self.pair = coded.indices.to_numpy(zero_copy_only=False)
        pairs = coded.dictionary.to_numpy()
        joined = pc.binary_join_element_wise(
            terms.distinct.take(pa.array(pairs // n)), terms.distinct.take(pa.array(pairs % n)), pa.scalar(b" ", pa.large_binary())
        )
        self.word_bucket = (crc32_all(terms.distinct) % np.uint32(buckets)).astype(np.int64)
        self.pair_bucket = (crc32_all(joined) % np.uint32(buckets)).astype(np.int64)

    def counts(self, buckets: int) -> np.ndarray:
        """Occurrences of each bucket's features."""
        out = np.zeros(buckets, dtype=np.int64)
        np.add.at(out, self.word_bucket, np.bincount(self.word, minlength=len(self.word_bucket)))
        np.add.at(out, self.pair_bucket, np.bincount(self.pair, minlength=len(self.pair_bucket)))
        return out

    def sums(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of features of each text, and the sum of their gains."""
        first = self.terms.first
        total = np.append(0, np.cumsum(gains[self.word_bucket][self.word]))
        pairs = np.append(0, np.cumsum(gains[self.pair_bucket][self.pair]))
        border = np.searchsorted(self.left, first)
        # the pairs of a text begin at its words but the last, so they lie between its borders
        size = np.diff(first) + np.diff(border)
        return size, np.diff(total[first]) + np.diff(pairs[border])


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: occurrences of all features of all whole texts; buckets without any are left out.

    Each task adds up its texts and sends one row per bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "t"):
                total += _Features(part.column("t"), buckets).counts(buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    picked = docs.select(F.col(text).alias("t"))
    return picked.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def target_gains(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", buckets: int = BUCKETS) -> list[int]:
    """Gain of every bucket: ``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` in doubles, where s of the S features
    of ``docs`` and t of the T features of ``target`` fall into the bucket and B is their number."""
    counts = []
    for df, name in ((docs, text), (target, target_text)):
        found = {r.bucket: r.n for r in bucket_counts(df, name, buckets).collect()}  # at most one row per bucket
        counts.append([found.get(b, 0) for b in range(buckets)])
    s, t = counts
    raw, wanted = float(sum(s) + buckets), float(sum(t) + buckets)
    return [floor(1000 * log(float(y + 1) * raw / (float(x + 1) * wanted))) for x, y in zip(s, t)]


def _noise(key: str, seed: int) -> int:
    h = int(sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return floor(-1000 * log(-log((h + 0.5) / 4294967296)))


def importance_scores(docs: DataFrame, gains: list[int], key: str = "doc_id", text: str = "text", seed: int = 7) -> DataFrame:
    """``(key, n_words, n_features, weight, score)`` of every row.

    ``weight`` is the floored mean gain of the text's features, 0 without any; ``score`` adds Gumbel noise drawn
    from the key (null: as an empty text), so reruns agree. Null and empty texts have no features.
    """
    table, buckets = np.array(gains, dtype=np.int64), len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                features = _Features(part.column("t"), buckets)
                size, total = features.sums(table)
                weight = np.where(size > 0, total // np.maximum(size, 1), 0)
                noise = np.array([_noise(k or "", seed) for k in part.column("s").to_pylist()], dtype=np.int64)
                columns = [features.terms.counts, size, weight, weight + noise]
                yield pa.RecordBatch.from_arrays(
                    [part.column("k"), *[pa.array(c.astype(np.int64)) for c in columns]],
                    names=["k", "n_words", "n_features", "weight", "score"],
                )

    kind = docs.schema[key].dataType.simpleString()
    picked = docs.select(F.col(key).alias("k"), F.col(key).cast("string").alias("s"), F.col(text).alias("t"))
    scored = picked.mapInArrow(run, f"k {kind}, n_words long, n_features long, weight long, score long")
    return scored.withColumnRenamed("k", key)


def rank_drawn(scored: DataFrame, key: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3, ... over the drawn rows by falling score, ties to the smaller key; else null.

    Of the N rows with at least ``least_words`` words, ``floor(percent * N / 100)`` are drawn. Rows of one key
    and score are drawn in any order; null keys come first among ties. Ranks come from a range sort whose ranges are counted.
    """
    scored = cut_lineage(scored, "scores")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    ranked = with_ordinal(able, [F.col("score").desc(), F.col(key).asc_nulls_first()], "rank")
    place = F.when(F.col("rank") < drawn, F.col("rank") + 1)
    return ranked.withColumn("rank", place).unionByName(rest)


def importance_ranks(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = 7, buckets: int = BUCKETS,
) -> DataFrame:
    """``(key, n_words, n_features, weight, score, rank)`` for every row of ``docs``; empty tables give no rows, an
    empty target lets texts of rare features win."""
    gains = target_gains(docs, target, text, target_text, buckets)
    return rank_drawn(importance_scores(docs, gains, key, text, seed), key, percent, least_words)


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = 7, buckets: int = BUCKETS,
) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns. Keys should be unique: rows of a drawn key all stay."""
    ranked = importance_ranks(docs, target, key, text, target_text, percent, least_words, seed, buckets)
    keys = ranked.where(F.col("rank").isNotNull()).select(F.col(key).alias("_drawn_" + key)).distinct()
    return docs.join(keys, F.col(key).eqNullSafe(F.col("_drawn_" + key)), "left_semi")
