"""Benchmark decontamination: texts are streamed through suffix automata of the normalised test items.

The items are cut into automata of bounded size, which Spark builds side by side. They go to the tasks by broadcast,
in groups of a checked size; further groups take another pass over the texts, whose findings are joined to
those so far, row by row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from nearfield.llm.automaton import Automaton
from nearfield.llm.terms import Terms
from nearfield.llm.words import slices
from nearfield.session import cut_lineage

WINDOW = 10
PART_WORDS = 200_000
RESIDENT_BYTES = 256 << 20
SPAN = StructType([StructField(n, LongType(), False) for n in ("start", "end", "begin_byte", "end_byte")])
FOUND = [
    StructField("n_words", LongType()),
    StructField("spans", ArrayType(SPAN, False)),
    StructField("items", ArrayType(StringType(), False)),
]


@dataclass
class TestItems:
    """A written table of automata ``(part, size, names, data)``, and its parts in groups of bounded size."""

    table: DataFrame
    groups: list[list[int]]
    window: int


def index_items(
    items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW,
    part_words: int = PART_WORDS, resident_bytes: int = RESIDENT_BYTES,
) -> TestItems:
    """Automata of the windows of ``items``: ``window`` consecutive words, or a shorter item as a whole.

    An item is named by its key as a string (null: empty); rows of one key are one item. Texts without
    words, null ones among them, have no window. Long items are cut into pieces that overlap by
    ``window - 1`` words, so every window lies in one piece and a part holds about ``part_words`` words.
    """
    if window < 1 or part_words < 1:
        raise ValueError("window and part_words must be positive")
    piece = max(part_words // 16, window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                terms = Terms(part.column("t"))
                words = terms.distinct.take(pa.array(terms.ids))
                names, first = part.column("k").to_pylist(), terms.first.tolist()
                rows = [
                    (name, b - a <= piece, words[at : min(at + piece, b)].to_pylist())
                    for name, a, b in zip(names, first, first[1:])
                    for at in range(a, max(a + 1, b - window + 1) if b > a else a, piece - window + 1)
                ]
                kinds = [pa.string(), pa.bool_(), pa.list_(pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["name", "whole", "words"]
                )

    def build(key: tuple, group: pa.Table) -> pa.Table:
        names, words, whole = (group.column(c).to_pylist() for c in ("name", "words", "whole"))
        known = {n: i for i, n in enumerate(sorted(set(names)))}
        data = Automaton.build(zip([known[n] for n in names], words, whole), window).dump()
        return pa.table({"part": [key[0].as_py()], "size": [len(data)], "names": [list(known)], "data": [data]})

    named = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.col(text).alias("t"))
    pieces = cut_lineage(named.mapInArrow(cut, "name string, whole boolean, words array<binary>").distinct(), "items")
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    part = F.pmod(F.xxhash64("name", "words"), F.lit(max(1, -(-total // part_words))))
    built = pieces.withColumn("part", part).groupBy("part").applyInArrow(
        build, "part long, size long, names array<string>, data binary"
    )
    table = cut_lineage(built, "automata")
    groups, held = [], 0
    for row in table.select("part", "size").orderBy("part").collect():  # one row per part_words words
        if not groups or held + row["size"] > resident_bytes:
            groups.append([])
            held = 0
        groups[-1].append(row.part)
        held += row["size"]
    return TestItems(table, groups, window)


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, pa.Array]:
    """For a list column: the row of every element, and the elements."""
    column = batch.column(name)
    counts = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(column)), counts), column.flatten()


def _spans(terms: Terms, texts: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Joined word ranges of every text, with the bytes they take."""
    change = np.zeros(len(terms) + 1, dtype=np.int64)
    np.add.at(change, spans[:, 0], 1)
    np.add.at(change, spans[:, 1], -1)
    hit = np.append(np.cumsum(change)[:-1] > 0, False)
    joined = np.append(False, hit[:-1])
    joined[terms.first] = False  # a range ends with its text
    opens = np.flatnonzero(hit & ~joined)
    closes = np.flatnonzero(hit[:-1] & ~(hit & joined)[1:]) + 1
    text = np.searchsorted(terms.first, opens, side="right") - 1
    columns = [opens - terms.first[text], closes - terms.first[text]]
    columns += [terms.starts[opens] - terms.offsets[text], terms.ends[closes - 1] - terms.offsets[text]]
    fields = [pa.field(f.name, pa.int64(), False) for f in SPAN]
    return np.searchsorted(text, np.arange(texts + 1)), pa.StructArray.from_arrays(list(map(pa.array, columns)), fields=fields)


def match_items(docs: DataFrame, items: TestItems, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` and ``items``: what of each whole text occurs in test items.

    ``spans`` are the joined ranges of words inside an occurrence of a window, as word numbers and as
    bytes; ``items`` the names of all items with such a window, in byte order. Columns of ``docs`` with
    those names are replaced. Null and empty texts have no words; repeated rows are answered each; empty tables
    on either side give no rows or no findings.
    """
    made = [f.name for f in FOUND]
    kept = [f for f in docs.schema.fields if f.name not in made]
    inner = [StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(kept)]
    shape = StructType([*inner, StructField("t", StringType()), *FOUND])
    empty = [F.lit(0).cast("long"), *[F.array().cast(f.dataType) for f in FOUND[1:]]]
    found = docs.select(
        *[F.col(f"`{f.name}`").alias(i.name) for f, i in zip(kept, inner)], F.col(text).alias("t"),
        *[c.alias(n) for c, n in zip(empty, made)],
    )
    context = docs.sparkSession.sparkContext
    for number, group in enumerate(items.groups or [[]]):
        rows = items.table.where(F.col("part").isin(group)).collect()  # at most resident_bytes, or one part
        shared = context.broadcast([(r.names, bytes(r.data)) for r in rows])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            loaded = [(np.array(names, dtype=object), Automaton.load(data)) for names, data in shared.value]
            for batch in batches:
                for part in slices(batch, "t"):
                    terms, n = Terms(part.column("t")), part.num_rows
                    of, before = _lists(part, "spans")
                    ranges = [terms.first[of][:, None] + np.stack([before.field(i).to_numpy() for i in (0, 1)], axis=1)]
                    of, before = _lists(part, "items")
                    hits = set(zip(of.tolist(), before.to_pylist()))
                    for names, automaton in loaded:
                        spans, pairs = automaton.matches(terms.distinct, terms.ids, terms.first)
                        ranges.append(spans)
                        hits.update(zip(pairs[:, 0].tolist(), names[pairs[:, 1]].tolist()))
                    bounds, values = _spans(terms, n, np.concatenate(ranges))
                    hits = sorted((t, name.encode(), name) for t, name in hits)
                    cuts = np.searchsorted(np.array([h[0] for h in hits], dtype=np.int64), np.arange(n + 1))
                    columns = [
                        pa.array(terms.counts.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array([h[2] for h in hits], pa.string())),
                    ]
                    old = [part.column(i) for i in range(part.num_columns - len(FOUND))]
                    yield pa.RecordBatch.from_arrays([*old, *columns], names=part.schema.names)

        found = found.mapInArrow(run, shape)
        if number + 1 < len(items.groups):
            found = cut_lineage(found, "matches")
    return found.select(*[F.col(i.name).alias(f.name) for f, i in zip(kept, inner)], *made)


def hit_words(spans: Column) -> Column:
    """Number of words inside spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def decontaminate(
    docs: DataFrame, items: TestItems, text: str = "text", least_words: int = 1, most_share: float = 0.5
) -> DataFrame:
    """``docs`` without passages of test items.

    Spans of at least ``least_words`` words are cut out of the text, from their first word to their last.
    Rows in which spans hold more than ``most_share`` of the words are dropped whole. Other rows and columns stay as they are.
    """
    tested = "_tested_" + "_".join(docs.columns)  # clashes with no column, and not with what matching adds
    matched = match_items(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(tested), F.col(text).alias("t")), items, "t")
    matched = matched.where(hit_words(F.col("spans")) <= most_share * F.col("n_words"))
    cut = F.filter("spans", lambda s: s["end"] - s["start"] >= least_words)
    raw = F.col("t").cast("binary")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(cut, lambda s: s["end_byte"]))
    ends = F.concat(F.transform(cut, lambda s: s["begin_byte"]), F.array(F.octet_length(F.col("t")).cast("long")))
    pieces = F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")),
        lambda p: F.substr(raw, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")).cast("string"),
    )
    kept = F.when(F.size(cut) > 0, F.array_join(pieces, "")).otherwise(F.col("t"))
    return matched.select(*[kept.alias(c) if c == text else F.col(tested)[c].alias(c) for c in docs.columns])


def contamination_digest(docs: DataFrame, items: TestItems, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, n_hit, n_items, items_sha256, contaminated)``, one row per row of ``docs``."""
    n_hit = hit_words(F.col("spans"))
    return match_items(docs.select(key, text), items, text).select(
        key,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
