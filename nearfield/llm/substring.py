"""Substring dedup by level-wise doubling: passages repeated across documents are found and removed.

A run of words can repeat only if each of its runs of half that length does. So the levels begin with short runs
and double their length: what repeats at one length alone is extended to the next, until the window's
length is reached or nothing repeats. On the first level one run, picked by content (the smallest hash), stands for
each run of the second, so it carries about a quarter of all positions.
"""

from __future__ import annotations

import gc
import hashlib
import time
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.llm.words import find_words, hash_windows, hash_words, slices, text_bytes
from nearfield.session import cut_lineage, discard, scratch_path

WINDOW = 13
ARROW = {"long": pa.int64(), "string": pa.string()}
START = 7  # the shortest runs are of at most so many words
_CHECK = np.uint64(0xD6E8FEB86659FD93)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now, not at some later collection.

    Python's handles go first, then what they held in the JVM; that takes two rounds.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def level_lengths(window: int) -> list[int]:
    """Lengths of the levels: the window's, halved until it is short; at least two."""
    out = [window]
    while out[0] > START or len(out) == 1:
        out.insert(0, (out[0] + 1) // 2)
    return out


class Windows:
    """The runs of ``window`` words in a slice of documents: where they start, and in which document."""

    def __init__(self, column: pa.Array, window: int):
        self.data, self.offsets = text_bytes(column)
        starts, ends, self.first = find_words(self.data, self.offsets)
        self._words, self._window = hash_words(self.data, starts, ends), window
        count = max(0, len(starts) - window + 1)
        sizes = np.diff(self.first)
        last = np.repeat(self.first[1:], sizes)[:count]
        self.at = np.flatnonzero(np.arange(count) + window <= last)
        self.doc = np.repeat(np.arange(len(self.first) - 1), sizes)[:count][self.at]

    def standing(self, n: int) -> np.ndarray:
        """For every window the least hash of its runs of ``n`` words."""
        runs, count = hash_windows(self._words, n), max(0, len(self._words) - self._window + 1)
        least = np.full(count, np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(self._window - n + 1):
            np.minimum(least, runs[at : at + count], out=least)
        return least[self.at].view(np.int64)

    def ends(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first and the last ``n`` words of every window."""
        runs = hash_windows(self._words, n).view(np.int64)
        return runs[self.at], runs[self.at + self._window - n]

    def full(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash (64 bits) and check value (32 more) of every window."""
        h = hash_windows(self._words, self._window)
        check = hash_windows(self._words * _CHECK, self._window)
        return h[self.at].view(np.int64), (check[self.at] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _per_document(values: list[np.ndarray], doc: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of ``values`` within each document."""
    order = np.lexsort((*values[::-1], doc))
    values, doc = [v[order] for v in values], doc[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | np.any([v[1:] != v[:-1] for v in values], axis=0)
    return [v[new] for v in values], doc[new]


def _levels(docs: DataFrame, window: int) -> DataFrame | None:
    """``(id, h)``: windows of a document whose words also start in one with a smaller id; None if nothing repeats."""
    spark = docs.sparkSession
    texts = docs.where("id IS NOT NULL AND text IS NOT NULL").select("id", "text")
    lengths = level_lengths(window)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = Windows(part.column("text"), lengths[1])
                (h,), doc = _per_document([w.standing(lengths[0])], w.doc)
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(doc)), pa.array(h)], names=["id", "h"])

    at = scratch_path(spark, "runs")
    level = cut_lineage(texts.mapInArrow(runs, "id long, h long"), path=at)
    repeated = level.groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("h")
    kept_at = scratch_path(spark, "repeated")
    kept = cut_lineage(level.join(repeated, "h").select("id", "h"), path=kept_at)
    del level, repeated
    discard(spark, at)
    release(spark)

    for number in range(1, len(lengths)):
        if kept.isEmpty():
            discard(spark, kept_at)
            return None
        by_doc = kept.groupBy("id").agg(F.collect_set("h").alias("runs"))
        extend = _extension(lengths[number - 1], lengths[number], number == 1)
        at = scratch_path(spark, "windows")
        windows = cut_lineage(texts.join(by_doc, "id").mapInArrow(extend, "id long, h long, c int"), path=at)
        del kept, by_doc
        discard(spark, kept_at)
        release(spark)
        first = windows.groupBy("h", "c").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b")
        met = windows.join(first, ["h", "c"])
        if number == len(lengths) - 1:
            met = met.where("id > a")
        kept_at = scratch_path(spark, "repeated")
        kept = cut_lineage(met.select("id", "h"), path=kept_at)
        del windows, first, met
        discard(spark, at)
        release(spark)
    return kept


def _extension(short: int, long: int, first: bool) -> Callable:
    """Runs of ``long`` words of texts with the repeated ``runs`` of ``short`` words they are built on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = Windows(part.column("text"), long)
                below = (w.standing(short),) if first else w.ends(short)
                live = np.zeros(len(w.at), dtype=bool)
                bounds = np.searchsorted(w.doc, np.arange(part.num_rows + 1))
                for d in range(part.num_rows):
                    own = slice(bounds[d], bounds[d + 1])
                    known = part.column("runs")[d].values.to_numpy()
                    live[own] = np.logical_and.reduce([np.isin(h[own], known) for h in below])
                h, check = w.full()
                (h, check), doc = _per_document([h[live], check[live]], w.doc[live])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(doc)), pa.array(h), pa.array(check)], names=["id", "h", "c"]
                )

    return run


def _apply(docs: DataFrame, key: str, text: str, window: int, extra: dict[str, tuple[str, Callable]]) -> DataFrame:
    """``docs`` under inner names with what ``extra`` makes of (words, removed mask) of every row."""
    keys = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    found = _levels(keys, window)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "id long, h long")
    gone = found.groupBy("id").agg(F.collect_set("h").alias("gone"))
    inner = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(*[F.col(c).alias(i) for c, i in inner.items()], F.col(key).cast("long").alias("id"))
    joined = own.join(gone, "id", "left").drop("id")
    at = inner[text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                w = Windows(part.column(at), window)
                h, _ = w.full()
                bounds = np.searchsorted(w.doc, np.arange(part.num_rows + 1))
                data = w.data.tobytes()
                made: list[list] = [[] for _ in extra]
                for d in range(part.num_rows):
                    n = int(w.first[d + 1] - w.first[d])
                    removed = np.zeros(n + 1, dtype=np.int64)
                    hashes = part.column("gone")[d].values
                    if hashes is not None and len(hashes):
                        own = slice(bounds[d], bounds[d + 1])
                        hit = w.at[own][np.isin(h[own], hashes.to_numpy())] - w.first[d]
                        np.add.at(removed, hit, 1)
                        np.add.at(removed, hit + window, -1)
                    removed = np.cumsum(removed)[:n] > 0
                    words = data[w.offsets[d] : w.offsets[d + 1]].split()
                    if removed.any():
                        words = list(compress(words, (~removed).tolist()))
                    for out, (_, make) in zip(made, extra.values()):
                        out.append(make(words, removed))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in inner.values()), *(pa.array(m, ARROW[kind]) for m, (kind, _) in zip(made, extra.values()))],
                    names=[*inner.values(), *extra],
                )

    kinds = [f"{i} {docs.schema[c].dataType.simpleString()}" for c, i in inner.items()]
    kinds += [f"{name} {kind}" for name, (kind, _) in extra.items()]
    return joined.mapInArrow(run, ", ".join(kinds))


def substring_digest(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``(key, n_words, n_removed, kept_sha256)`` for every row.

    Removed is each word covered by a ``window`` of consecutive words that also starts in a row with
    a smaller ``key``; windows are judged on the input. ``kept_sha256`` is of the kept words joined by
    one space. Null and empty texts have no words; rows with a null key neither lose words nor make
    others lose them; rows sharing a key count as one document and are answered each. Texts of
    fewer words than the window stay whole. Equality is decided on 96 bits of hash.
    """
    made = _apply(
        docs.select(key, text),
        key,
        text,
        window,
        {
            "n_words": ("long", lambda words, removed: len(removed)),
            "n_removed": ("long", lambda words, removed: int(removed.sum())),
            "kept_sha256": ("string", lambda words, removed: hashlib.sha256(b" ".join(words)).hexdigest()),
        },
    )
    return made.select(F.col("_c0").alias(key), "n_words", "n_removed", "kept_sha256")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the repeated passages, in the same columns.

    A row that lost words holds the rest joined by one space, the others are unchanged; rows that
    lost every word are left out.
    """
    made = _apply(
        docs, key, text, window, {"_kept": ("string", lambda words, removed: b" ".join(words).decode() if removed.any() else None)}
    )
    made = made.where("_kept IS NULL OR _kept != ''")
    columns = [
        (F.coalesce("_kept", f"_c{i}") if c == text else F.col(f"_c{i}")).alias(c) for i, c in enumerate(docs.columns)
    ]
    return made.select(*columns)
