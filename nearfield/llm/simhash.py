"""SimHash near-duplicates: pigeonhole blocks, joined and verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.llm.components import connected_components
from nearfield.session import cut_lineage

SEED = 42
SHINGLE = 3
BITS = 64
COUNT_ROWS = 1 << 16


def _fingerprint(text: bytes, n: int) -> int:
    """Majority of the shingle hashes, bit by bit; 0 for a text without words."""
    words = text.lower().split()  # ASCII only: A-Z, and space with \\x09-\\x0D
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= n:
        return digest(b" ".join(words), SEED)
    count = len(words) - n + 1
    shingles = map(b" ".join, zip(*(words[i:] for i in range(n))))
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype=np.uint64, count=count)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, count, COUNT_ROWS):
        part = hashes[at : at + COUNT_ROWS]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * ones > count).tolist())


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(key, fp)``: the 64-bit SimHash of each row's whole text as a signed long.

    The text is lower-cased over A-Z and cut into words at space and ``\\x09-\\x0D``; features are all
    runs of ``shingle`` words, repeats included (fewer words: the whole sequence). Null and empty
    texts get 0. Only ``key`` and ``text`` are read, so other columns may have any name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = [_fingerprint(t.as_py() or b"", shingle) for t in texts]
            fp = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], names=["k", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    picked = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return picked.mapInArrow(run, f"k {kind}, fp long").withColumnRenamed("k", key)


def _parts(start: int, width: int, n: int) -> list[tuple[int, int]]:
    """``n`` neighbouring (start, width) parts of a bit range."""
    cuts = [start + width * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _bits(fp: Column, parts: list[tuple[int, int]]) -> Column:
    """The given bit ranges of ``fp``, put next to each other."""
    out = F.lit(0).cast("long")
    for start, width in parts:
        piece = F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        out = F.shiftleft(out, width).bitwiseOR(piece)
    return out


def _keys(fp: Column, distance: int) -> Column:
    """Blocking keys: two fingerprints within ``distance`` bits share at least one.

    Of ``distance + 1`` blocks one is free of differences; of the rest, cut the same way, so is one
    more. A key is such a pair of blocks and its number.
    """
    keys, n = [], distance + 1
    for i, (start, width) in enumerate(_parts(0, BITS, n)):
        rest = [(0, start)] * (start > 0) + [(start + width, BITS - start - width)] * (start + width < BITS)
        length = sum(w for _, w in rest)
        for j, (at, w) in enumerate(_parts(0, length, n)):
            second, left = [], w
            for s, size in rest:  # the bits at..at+w of the concatenated rest
                if at < size and left:
                    take = min(size - at, left)
                    second.append((s + at, take))
                    left -= take
                at = max(0, at - size)
            block = _bits(fp, [(start, width), *second])
            keys.append(F.struct(F.lit(i * n + j).alias("block"), block.alias("bits")))
    return F.array(*keys)


def simhash_links(prints: DataFrame, distance: int = 2, pair_group: int = 64) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp``, enough to connect all pairs that
    differ in at most ``distance`` bits, and none between others.

    Groups that share a key are joined with themselves and verified while they hold up to
    ``pair_group`` fingerprints. In larger ones (copies with small edits) all-pairs would be
    quadratic, so pairs meet there at a value half way: each fingerprint lists all values within
    ``distance // 2`` bits (rounded up on one side), equal values lie within ``distance``, and a
    minimum per value links them. Both ways are exact.
    """
    if distance not in (1, 2):
        raise ValueError("distance must be 1 or 2")
    keyed = prints.select("fp").distinct().select("fp", F.explode(_keys(F.col("fp"), distance)).alias("key"))
    keyed = keyed.select("fp", "key.block", "key.bits")
    sizes = keyed.groupBy("block", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = cut_lineage(keyed.join(sizes, ["block", "bits"]), "blocks")

    few = shared.where(F.col("n") <= pair_group).drop("n")
    left, right = few.withColumnRenamed("fp", "a"), few.withColumnRenamed("fp", "b")
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    pairs = left.join(right, ["block", "bits"]).where(close).select("a", "b")

    flips = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    near = F.concat(F.array(F.lit(0).cast("long")), flips)
    many = shared.where(F.col("n") > pair_group).select("fp").distinct()
    spread = many.select("fp", F.explode(near).alias("flip")).withColumn("mid", F.col("fp").bitwiseXOR(F.col("flip")))
    if distance == 1:  # one side keeps its value, so that equal values differ by one bit only
        spread = spread.withColumn("own", F.col("flip") == 0)
        owner = spread.where("own").select("mid", F.col("fp").alias("b"))
        met = spread.join(owner, "mid").where("fp != b").selectExpr("fp a", "b")
    else:
        first = spread.groupBy("mid").agg(F.min("fp").alias("b"))
        met = spread.join(first, "mid").where("fp != b").selectExpr("fp a", "b")
    return pairs.unionByName(met)


def simhash_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = 2
) -> DataFrame:
    """One row per document: ``(key, fingerprint, component_id)``.

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` the smallest ``key`` reachable over
    links of at most ``distance`` differing bits, the row's own included. Equal fingerprints are
    one node throughout, so groups of exact copies cost nothing. Rows with a null key keep their
    place and take the smallest other key of their group (null if there is none); repeated rows
    are answered each; an empty table gives an empty result.
    """
    prints = cut_lineage(fingerprints(docs, key, text, shingle), "simhash")
    nodes = prints.groupBy("fp").agg(F.min(key).alias("least"))
    labels = connected_components(simhash_links(prints, distance)).withColumnRenamed("id", "fp")
    nodes = nodes.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    of = nodes.join(least, "component").select("fp", "component_id")
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return prints.join(of, "fp").select(key, shown, "component_id")


def simhash_dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = 2
) -> DataFrame:
    """``docs`` with one row of every near-duplicate group: that of the smallest ``key``.

    Of repeated rows with that key one stays; rows without a key stay as they are. Other columns may have any name.
    """
    groups = simhash_groups(docs, key, text, shingle, distance)
    own = "_keep_" + "_".join(docs.columns)
    keep = groups.where(F.col(key) == F.col("component_id")).select(F.col(key).alias(own)).distinct()
    known = docs.join(keep, F.col(key) == F.col(own), "left_semi").dropDuplicates([key])
    return known.unionByName(docs.where(F.col(key).isNull()))
