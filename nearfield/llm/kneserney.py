"""Interpolated modified Kneser-Ney models of order 2 or 3, counted in Spark and read from compact arrays.

Words are told apart by 64-bit hashes and numbered by rank in hash order. Tasks count their part of the text and
send each shard one packed row; a shard merges them and writes its n-grams as runs below their context: words and
counts that follow a word, and below each two words which of those follow them. What a shard knows of words and of contexts that other
shards share is added up in a second exchange. Scoring tasks map the arrays into memory and look up the distinct
trigrams of some texts, in rank order.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.llm.files import open_fs, own_name
from nearfield.llm.substring import release
from nearfield.llm.words import LOWER, find_words, hash_words, mix, slices, text_bytes
from nearfield.session import cut_lineage, scratch_path

END = np.uint64(0x5BE0CD19137E2179)  # end of a text
_JOIN = np.uint64(0x9E3779B97F4A7C15)
FLUSH_TOKENS = 2_000_000
SHARD_TOKENS = 2_000_000
SCORE_TOKENS = 1_000_000  # looked up together
MOST_BITS = 16
LOW32 = np.uint64((1 << 32) - 1)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (A-Z lower-cased, one end after each text) and the n + 1 offsets of the texts."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, first = find_words(data, offsets)
    words = hash_words(data, starts, ends)
    n = len(first) - 1
    bounds = first + np.arange(n + 1)
    out = np.empty(len(words) + n, dtype=np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(first))] = words
    out[bounds[1:] - 1] = END
    return out, bounds


class _Texts:
    """Tokens of some texts as numbers of their distinct words; the number after the last stands before a text."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]]):
        sizes = np.cumsum([0] + [len(words) for words, _ in parts])
        self.starts = np.concatenate([bounds[:-1] + at for (_, bounds), at in zip(parts, sizes.tolist())])
        self.ids, self.w = np.unique(np.concatenate([words for words, _ in parts]), return_inverse=True)

    def before(self, words: np.ndarray) -> np.ndarray:
        """The word before each word."""
        out = np.empty_like(words)
        out[1:] = words[:-1]
        out[self.starts] = len(self.ids)
        return out

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every token with the two words before it, the last first; at order 2 the farther one is 0."""
        u = self.before(self.w)
        return u, self.w, self.before(u) if order == 3 else np.zeros_like(u)


def _keys(u: np.ndarray, w: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, list[np.ndarray] | int]:
    """One key for each triple of numbers below 2**32, in the order of the triples; what undoes it."""
    u, w, t = (x.astype(np.uint64) for x in (u, w, t))
    bits = max((int(x.max()).bit_length() for x in (u, w, t) if len(x)), default=0)
    if 3 * bits <= 64:
        return (u << np.uint64(2 * bits)) | (w << np.uint64(bits)) | t, bits
    pairs, p = np.unique((u << np.uint64(32)) | w, return_inverse=True)
    return (p.astype(np.uint64) << np.uint64(32)) | t, [pairs]


def _unkeyed(key: np.ndarray, how: list[np.ndarray] | int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if isinstance(how, list):
        pair = how[0][(key >> np.uint64(32)).astype(np.int64)]
        out = pair >> np.uint64(32), pair & LOW32, key & LOW32
    else:
        bits, low = np.uint64(how), np.uint64((1 << how) - 1)
        out = key >> (bits + bits), (key >> bits) & low, key & low
    return tuple(x.astype(np.int64) for x in out)


def _first(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of values begins."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first, dtype=np.int64) if len(first) else np.zeros(0, dtype=np.int64)


def _cut(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal shards."""
    first = _first(shard)
    for a, b in zip(first.tolist(), np.append(first[1:], len(shard)).tolist()):
        yield int(shard[a]), slice(a, b)


def pair_hash(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(u.astype(np.uint64) * _JOIN + w.astype(np.uint64))


def _shard(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), dtype=np.int64)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, each in as many planes of bytes as its largest number needs."""
    out = [struct.pack("<I", len(columns))]
    for c in columns:
        width = max(1, (int(c.max()).bit_length() + 7) // 8) if len(c) else 1
        planes = np.ascontiguousarray(c, dtype="<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
        out += [struct.pack("<QI", len(c), width), planes.tobytes()]
    return b"".join(out)


def _unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 4
    for _ in range(struct.unpack_from("<I", data)[0]):
        n, width = struct.unpack_from("<QI", data, at)
        wide = np.zeros((n, 8), dtype=np.uint8)
        wide[:, :width] = np.frombuffer(data, np.uint8, n * width, at + 12).reshape(width, n).T
        out.append(wide.reshape(-1).view("<u8").astype(np.int64))
        at += 12 + n * width
    return out


def _unpacked(group: pa.Table) -> list[np.ndarray]:
    """Columns of all packed rows, one behind the other."""
    return [np.concatenate(c) for c in zip(*(_unpack(d) for d in group.column("data").to_pylist()))]


def _write_array(folder: str, shard: int, columns: list[np.ndarray]) -> str:
    """Columns of unsigned numbers one behind the other, after their widths and lengths."""
    fs, base = open_fs(folder)
    fs.create_dir(base, recursive=True)
    name = own_name(folder, shard, 0, ".arr")
    with fs.open_output_stream(open_fs(name)[1]) as stream:
        head = [len(columns), *(x for c in columns for x in (c.dtype.itemsize, len(c)))]
        stream.write(np.array(head, dtype="<u8").tobytes())
        for c in columns:
            stream.write(np.ascontiguousarray(c, dtype=c.dtype.newbyteorder("<")).tobytes())
            stream.write(bytes(-c.nbytes % 8))
    return name


def read_array(uri: str) -> list[np.ndarray]:
    """Columns of a written array; mapped where storage is mounted, else read."""
    fs, path = open_fs(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        raw = np.memmap(path, dtype=np.uint8, mode="r").view(np.ndarray)
    else:
        with fs.open_input_file(path) as file:
            raw = np.frombuffer(file.read(), dtype=np.uint8)
    count = int(raw[:8].view("<u8")[0])
    head, at, out = raw[8 : 8 + 16 * count].view("<u8").reshape(-1, 2), 8 + 16 * count, []
    for width, n in head.tolist():
        out.append(raw[at : at + width * n].view(f"<u{width}"))
        at += width * n + -width * n % 8
    return out


def _counts(n: np.ndarray) -> list[np.ndarray]:
    """Counts in a byte each; places and values of those that need more."""
    large = np.flatnonzero(n >= 255)
    return [np.minimum(n, 255).astype(np.uint8), large.astype(np.uint32), n[large].astype(np.uint64)]


def _counts_at(columns: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    out = columns[0][at].astype(np.int64)
    large = np.flatnonzero(out == 255)
    out[large] = columns[2][np.searchsorted(columns[1], at[large])]
    return out


def _facts(facts: np.ndarray) -> list[np.ndarray]:
    """Total of a context and words seen once, twice, more often (rows) in 4 bits each; places and values of larger ones."""
    small = facts.max(axis=0, initial=0) < 15
    code = np.where(small, (facts << np.array([[0], [4], [8], [12]])).sum(axis=0), 0xFFFF)
    large = np.flatnonzero(~small)
    return [code.astype(np.uint16), large.astype(np.uint32), facts[:, large].T.reshape(-1).astype(np.uint64)]


def _facts_at(columns: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    code = columns[0][at].astype(np.int64)
    out = (code >> np.array([[0], [4], [8], [12]])) & 15
    large = np.flatnonzero(code == 0xFFFF)
    out[:, large] = columns[2].reshape(-1, 4)[np.searchsorted(columns[1], at[large])].T
    return out


def _places(starts: np.ndarray) -> list[np.ndarray]:
    """Ascending places in two bytes each, and where the bytes above begin to grow."""
    return [(starts & 0xFFFF).astype(np.uint16), np.repeat(np.arange(len(starts)), np.diff(starts >> 16, prepend=0)).astype(np.uint32)]


def _places_at(columns: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    return (np.searchsorted(columns[1], at, side="right") << 16) | columns[0][at].astype(np.int64)


def _within(values: np.ndarray, low: np.ndarray, end: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each wanted value is in its sorted run of ``values``, and where."""
    low, high = low.astype(np.int64), end.astype(np.int64)
    active = np.flatnonzero(low < high)
    a, b, want = low[active], high[active], wanted[active]
    while len(active):
        middle = (a + b) >> 1
        below = values[middle] < want
        a, b = np.where(below, middle + 1, a), np.where(below, b, middle)
        low[active] = a
        going = a < b
        active, a, b, want = active[going], a[going], b[going], want[going]
    there = np.flatnonzero(low < end)
    found = np.zeros(len(low), dtype=bool)
    found[there] = values[low[there]] == wanted[there]
    return found, low


@dataclass
class BigramModel:
    """Where the arrays of each shard lie, and the few numbers all scores share."""

    order: int
    bits: int
    train_tokens: int
    vocabulary: int
    ids: dict[int, str]  # hashes and counts of words
    base: np.ndarray  # rank of each shard's first word
    hot: np.ndarray  # ranks of frequent words
    words: dict[int, str] = field(default_factory=dict)
    grams: dict[int, str] = field(default_factory=dict)
    spread: dict[int, str] = field(default_factory=dict)  # contexts of two words, the second a frequent one
    low: tuple[float, float, float] = (0.5, 1.0, 1.5)
    discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    triple_discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    every: int = 0  # distinct bigrams
    p_unknown: float = 1.0

    @property
    def begin(self) -> int:
        """Rank of what stands before a text; one more is that of unknown words."""
        return self.vocabulary

    @property
    def kind(self) -> type:
        return np.uint32 if self.vocabulary + 1 < 1 << 32 else np.uint64

    def home(self, ranks: np.ndarray) -> np.ndarray:
        """Shard of each word."""
        return np.minimum(np.searchsorted(self.base, ranks, side="right"), 1 << self.bits) - 1

    def spread_by(self, shard: np.ndarray, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Shards of bigrams, given those of their contexts: frequent contexts are spread by the bigram."""
        if len(self.hot):
            often = np.flatnonzero(np.isin(u, self.hot))
            shard[often] = _shard(pair_hash(u[often], w[often]), self.bits)
        return shard


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts; 1/2, 1, 3/2 where they do not exist."""
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(d if 0 < d < k else k / 2 for k, d in enumerate(found, 1))


def _of_counts(n: np.ndarray) -> list[int]:
    return [int((n == k).sum()) for k in (1, 2, 3, 4)]


def _context_facts(n: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.stack([_sums(x, first) for x in (n, n == 1, n == 2, n > 2)])


def fit_bigrams(docs: DataFrame, text: str = "text", shard_tokens: int = SHARD_TOKENS) -> BigramModel:
    """``fit_ngrams`` of order 2."""
    return fit_ngrams(docs, text, 2, shard_tokens)


def fit_ngrams(docs: DataFrame, text: str = "text", order: int = 3, shard_tokens: int = SHARD_TOKENS) -> BigramModel:
    """Count all rows of ``docs`` and write the model of order 2 or 3 below the shared folder.

    Null texts are empty; each text adds one end token. Every word, bigram and trigram is kept. At order 3
    bigrams count the different words before them; those that begin a text have none and keep their
    counts, and the first word of a text is scored by its bigram. The driver holds a few
    paths per shard (about ``shard_tokens`` tokens) and at most two frequent contexts per shard.
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    spark = docs.sparkSession
    texts = docs.select(F.col(text).alias("t"))

    def batches_of_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "t"):
                held.append(tokens(part.column("t")))
                size += len(held[-1][0])
                if size >= FLUSH_TOKENS:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in batches_of_tokens(batches):
            ids, n = np.unique(np.concatenate([words for words, _ in held]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), pa.array(n)], names=["id", "n"])

    unigrams = texts.mapInArrow(count_words, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    unigrams = cut_lineage(unigrams, "unigrams")
    release(spark)
    train, vocabulary = unigrams.agg(F.sum("n"), F.count(F.lit(1))).first()
    train = train or 0
    bits = min(MOST_BITS, max(0, (max(1, train) // shard_tokens).bit_length()))
    often = train / (2 << bits) if bits else train
    id_folder = scratch_path(spark, "ids")

    def store_ids(key: tuple, group: pa.Table) -> pa.Table:
        ids, n = (group.column(c).to_numpy() for c in ("id", "n"))
        at = np.argsort(ids.view(np.uint64))
        ids, n = ids.view(np.uint64)[at], n[at]
        hot = np.flatnonzero(n > often)  # at most two a shard, on average
        path = _write_array(id_folder, key[0].as_py(), [ids, *_counts(n)])
        return pa.table({
            "shard": [key[0].as_py()], "path": [path], "size": [len(ids)],
            "hot": [hot.tolist()], "ends": [bool((ids[hot] == END).any())],
        }).cast(pa.schema([("shard", pa.int64()), ("path", pa.string()), ("size", pa.int64()), ("hot", pa.list_(pa.int64())), ("ends", pa.bool_())]))

    shard = F.shiftrightunsigned("id", 64 - bits) if bits else F.lit(0).cast("long")
    listed = unigrams.withColumn("shard", shard).groupBy("shard")
    listed = listed.applyInArrow(store_ids, "shard long, path string, size long, hot array<long>, ends boolean").collect()
    release(spark)
    sizes = np.zeros(1 << bits, dtype=np.int64)
    sizes[[r.shard for r in listed]] = [r.size for r in listed]
    base = np.cumsum(sizes) - sizes
    hot = [int(base[r.shard]) + at for r in listed for at in r.hot] + [vocabulary] * any(r.ends for r in listed)
    model = BigramModel(order, bits, train, vocabulary, {r.shard: r.path for r in listed}, base, np.array(hot, dtype=np.int64))

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(model)
        for held in batches_of_tokens(batches):
            some = _Texts(held)
            held.clear()
            key, how = _keys(*some.grams(order))
            key.sort()
            first = _first(key)
            n = np.diff(np.append(first, len(key)))
            u, w, t = _unkeyed(key[first], how)
            ranks = np.append(reader.ranks(some.ids)[0], model.begin)
            u, w, t = ranks[u], ranks[w], ranks[t] if order == 3 else t
            shard = model.spread_by(model.home(u), u, w)
            if len(model.hot):
                at = np.argsort(shard.astype(np.uint16), kind="stable")
                u, w, t, n, shard = u[at], w[at], t[at], n[at], shard[at]
            shards, rows = [], []
            for number, part in _cut(shard):
                v, x = u[part], w[part]
                starts, pairs = _first(v), _first(v, x)
                of = np.diff(np.append(np.searchsorted(pairs, starts), len(pairs)))
                shards.append(number)
                rows.append(_pack(v[starts], of, x[pairs], np.diff(np.append(pairs, len(v))), n[part], t[part] if order == 3 else t[:0]))
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array(rows, pa.binary())], names=["shard", "data"])

    gram_folder, spread_folder, word_folder = (scratch_path(spark, x) for x in ("grams", "frequent", "words"))

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        """N-grams of a shard, written; rows of kind 0 (the shard) and, packed for other shards, of kind 1 (contexts of one
        word), 2 (how many words come before a word) and 3 (contexts of two words that other shards know too)."""
        number = key[0].as_py()
        parts: list[list[np.ndarray]] = [[], [], [], []]
        for data in group.column("data").to_pylist():
            v, of, x, sizes, n, t = _unpack(data)
            for held, column in zip(parts, (np.repeat(np.repeat(v, of), sizes), np.repeat(x, sizes), t if order == 3 else np.zeros(len(n), np.int64), n)):
                held.append(column)
        (us, u), (ws, w), (ts, t) = (np.unique(np.concatenate(p), return_inverse=True) for p in parts[:3])
        n = np.concatenate(parts[3])
        parts.clear()
        gram, how = _keys(u, w, t)
        at = np.argsort(gram)
        gram = gram[at]
        first = _first(gram)
        n = _sums(n[at], first)
        u, w, t = _unkeyed(gram[first], how)
        del gram, at
        pairs = _first(u, w)
        pair_u, pair_w = u[pairs], w[pairs]
        begins = us[u] == model.begin
        pair_n = _sums(n, pairs) if order == 2 else np.where(begins[pairs], n[pairs], np.diff(np.append(pairs, len(u))))
        start = np.searchsorted(pair_u, np.arange(len(us) + 1))
        facts = _context_facts(pair_n, start[:-1])
        kind = model.kind
        columns = [us.astype(kind), start.astype(np.uint32), ws[pair_w].astype(kind), *_counts(pair_n)]
        rows = [(1, shard, _pack(us[part], *facts[:, part])) for shard, part in _cut(model.home(us))]
        lefts = np.bincount(pair_w, minlength=len(ws))
        rows += [(2, shard, _pack(ws[part], lefts[part])) for shard, part in _cut(model.home(ws))]
        longer = [0] * 4
        if order == 3:
            inner = np.flatnonzero(~begins)
            follower = np.repeat(np.arange(len(pairs)), np.diff(np.append(pairs, len(u)))) - start[u]
            u, t, follower, n = u[inner], t[inner], follower[inner], n[inner]
            longer = _of_counts(n)
            at = np.argsort(_keys(u, t, follower)[0])
            u, t, follower, n = u[at], t[at], follower[at], n[at]
            of = _first(u, t)
            facts, left, right = _context_facts(n, of), ts[t[of]], us[u[of]]
            columns += [
                np.searchsorted(u[of], np.arange(len(us) + 1)).astype(np.uint32), left.astype(kind), *_facts(facts),
                *_places(np.append(of, len(n))), follower.astype(np.uint16 if follower.max(initial=0) < 1 << 16 else np.uint32), *_counts(n),
            ]
            if len(model.hot):
                at = np.flatnonzero(np.isin(right, model.hot))
                to = _shard(pair_hash(right[at], left[at]), bits)
                by = np.argsort(to, kind="stable")
                at, to = at[by], to[by]
                rows += [(3, shard, _pack(right[at[part]], left[at[part]], *facts[:, at[part]])) for shard, part in _cut(to)]
        path = _write_array(gram_folder, number, columns)
        kinds, shards, data = zip(*rows, (0, number, None))
        out = {"kind": pa.array(kinds, pa.int32()), "shard": pa.array(shards, pa.int64()), "data": pa.array(data, pa.binary())}
        nones = [None] * len(rows)
        out["path"] = pa.array([*nones, path], pa.string())
        out["counts"] = pa.array([*nones, [*_of_counts(pair_n), *longer]], pa.list_(pa.int64()))
        return pa.table(out)

    packed = texts.mapInArrow(count_grams, "shard long, data binary")
    known = packed.groupBy("shard").applyInArrow(merge, "kind int, shard long, data binary, path string, counts array<long>")
    known = cut_lineage(known, "merged")
    del packed
    release(spark)
    shards = known.where("kind = 0").select("shard", "path", "counts").collect()  # one row per shard
    model.grams = {r.shard: r.path for r in shards}
    found = np.array([r.counts for r in shards], dtype=np.int64).reshape(-1, 8).sum(axis=0).tolist()
    model.discounts, model.triple_discounts = _discounts(*found[:4]), _discounts(*found[4:])

    def store_words(key: tuple, group: pa.Table) -> pa.Table:
        number = key[0].as_py()
        last = number + 1 == 1 << bits
        lefts = np.zeros((vocabulary + 1 if last else base[number + 1]) - base[number], dtype=np.int64)
        facts = np.zeros((4, len(lefts)), dtype=np.int64)
        for kind, data in zip(group.column("kind").to_pylist(), group.column("data").to_pylist()):
            ranks, *more = _unpack(data)
            if kind == 1:
                facts[:, ranks - base[number]] += np.array(more)
            else:
                lefts[ranks - base[number]] += more[0]
        path = _write_array(word_folder, number, [*_counts(lefts), *_facts(facts)])
        counts = [int(lefts.sum()), *_of_counts(lefts), int((lefts > 2).sum())]
        return pa.table({"shard": pa.array([number], pa.int64()), "path": [path], "counts": pa.array([counts], pa.list_(pa.int64()))})

    words = known.where("kind IN (1, 2)").select("shard", "kind", "data").groupBy("shard")
    words = words.applyInArrow(store_words, "shard long, path string, counts array<long>").collect()
    model.words = {r.shard: r.path for r in words}
    model.every, *of, more = np.array([r.counts for r in words], dtype=np.int64).reshape(-1, 6).sum(axis=0).tolist()
    model.low = _discounts(*of)
    spare = (model.low[0] * of[0] + model.low[1] * of[1] + model.low[2] * more) / model.every if model.every else 1.0
    model.p_unknown = spare / (vocabulary + 1)

    def store_contexts(key: tuple, group: pa.Table) -> pa.Table:
        right, left, *facts = _unpacked(group)
        at = np.lexsort((left, right))
        right, left = right[at], left[at]
        first = _first(right, left)
        facts = np.stack([_sums(f[at], first) for f in facts])
        right, left = right[first], left[first]
        us = np.unique(right)
        start = np.searchsorted(right, np.append(us, us[-1:] + 1))
        path = _write_array(spread_folder, key[0].as_py(), [us.astype(model.kind), start.astype(np.uint32), left.astype(model.kind), *_facts(facts)])
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "path": [path]})

    if order == 3 and len(model.hot):
        shared = known.where("kind = 3").select("shard", "data").groupBy("shard")
        model.spread = {r.shard: r.path for r in shared.applyInArrow(store_contexts, "shard long, path string").collect()}
    release(spark)
    return model


class _Reader:
    """Looks up words and n-grams in the shards of a model."""

    def __init__(self, model: BigramModel):
        self.model, self._open = model, {}

    def _visit(self, paths: dict[int, str], shard: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """Each shard's columns, and which of the keys belong to it."""
        order = np.argsort(shard.astype(np.uint16), kind="stable")
        for number, part in _cut(shard[order]):
            if (path := paths.get(number)) is not None:
                if path not in self._open:
                    self._open[path] = read_array(path)
                yield order[part], self._open[path]

    def ranks(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and counts of words, given their sorted hashes."""
        m = self.model
        ranks, counts, shard = np.full(len(ids), m.begin + 1), np.zeros(len(ids), dtype=np.int64), _shard(ids, m.bits)
        for own, (keys, *n) in self._visit(m.ids, shard):
            at = np.minimum(np.searchsorted(keys, ids[own]), len(keys) - 1)
            there = keys[at] == ids[own]
            own, at = own[there], at[there]
            ranks[own], counts[own] = at + m.base[shard[own[:1]]], _counts_at(n, at)
        return ranks, counts

    def words(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many words come before each, and the facts of each as a context."""
        m = self.model
        lefts, facts = np.zeros(len(ranks), dtype=np.int64), np.zeros((4, len(ranks)), dtype=np.int64)
        known = np.flatnonzero(ranks <= m.begin)
        shard = m.home(ranks[known])
        for own, columns in self._visit(m.words, shard):
            at = ranks[known[own]] - m.base[shard[own[0]]]
            lefts[known[own]], facts[:, known[own]] = _counts_at(columns[:3], at), _facts_at(columns[3:], at)
        return lefts, facts

    def grams(self, u: np.ndarray, w: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of bigrams ``u w`` and of trigrams ``t u w``, and the facts of the contexts ``t u``."""
        m = self.model
        two, three, facts = np.zeros(len(u), dtype=np.int64), np.zeros(len(u), dtype=np.int64), np.zeros((4, len(u)), dtype=np.int64)
        for own, (us, start, ws, *rest) in self._visit(m.grams, m.spread_by(m.home(u), u, w)):
            own, at = self._contexts(own, us, u)
            low = start[at].astype(np.int64)
            pair, place = _within(ws, low, start[at + 1], w[own])
            two[own[pair]] = _counts_at(rest[:3], place[pair])
            if m.order == 3:
                begin, left, *rest = rest[3:]
                context, of = _within(left, begin[at], begin[at + 1], t[own])
                facts[:, own[context]] = _facts_at(rest[:3], of[context])
                both = np.flatnonzero(pair & context)
                run = [_places_at(rest[3:5], of[both] + i) for i in (0, 1)]
                there, where = _within(rest[5], *run, place[both] - low[both])
                three[own[both[there]]] = _counts_at(rest[6:], where[there])
        if m.order == 3 and len(m.hot):
            hot = np.flatnonzero(np.isin(u, m.hot))
            facts[:, hot] = 0  # a shard knows only its part
            for own, (us, start, left, *rest) in self._visit(m.spread, _shard(pair_hash(u[hot], t[hot]), m.bits)):
                own, at = self._contexts(hot[own], us, u)
                there, place = _within(left, start[at], start[at + 1], t[own])
                facts[:, own[there]] = _facts_at(rest, place[there])
        return two, three, facts

    @staticmethod
    def _contexts(own: np.ndarray, us: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``own`` whose word is in ``us``, and where."""
        at = np.minimum(np.searchsorted(us, u[own].astype(us.dtype)), len(us) - 1)
        there = us[at] == u[own]
        return own[there], at[there]


def score_texts(docs: DataFrame, model: BigramModel, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(key, *keep, n_tokens, n_known, train_tokens, base_score, score)`` for every row's whole text.

    Scores are base-10 logarithms of the text's probability: ``base_score`` under add-one unigrams,
    ``score`` under the model (perplexity is ``10 ** (-score / n_tokens)``). A null or empty text has
    the end token alone; words never seen share one probability. Rows are answered each; an empty table gives no rows.
    """
    keep = [key, *(keep or [])]
    inner = [f"_c{i}" for i in range(len(keep))]
    picked = docs.select(*[F.col(c).alias(i) for c, i in zip(keep, inner)], F.col(text).alias("_text"))
    base = log10(model.train_tokens + model.vocabulary + 1)
    low, middle, high = (np.array([0.0, *d]) for d in (model.low, model.discounts, model.triple_discounts))

    def probabilities(reader: _Reader, ranks: np.ndarray, u: np.ndarray, w: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Of distinct trigrams, given as places in ``ranks``."""
        lefts, (total, *seen) = reader.words(ranks)
        one = (lefts - low[np.minimum(lefts, 3)]) / max(model.every, 1) + model.p_unknown
        gamma = np.where(total > 0, middle[1:] @ np.array(seen) / np.maximum(total, 1), 1.0)
        n, longer, (of, *seen) = reader.grams(ranks[u], ranks[w], ranks[t])
        p = gamma[u] * one[w] + (n - middle[np.minimum(n, 3)]) / np.maximum(total[u], 1)
        if model.order == 2:
            return p
        return np.where(of > 0, (longer - high[np.minimum(longer, 3)] + (high[1:] @ np.array(seen)) * p) / np.maximum(of, 1), p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held, kept = _Reader(model), [], []

        def flush() -> pa.RecordBatch:
            some = _Texts(held)
            gram, how = _keys(*some.grams(model.order))
            gram, back = np.unique(gram, return_inverse=True)
            ranks, count = reader.ranks(some.ids)
            p = np.log10(probabilities(reader, np.append(ranks, model.begin), *_unkeyed(gram, how)))
            sizes = np.diff(np.append(some.starts, len(some.w)))
            columns = [
                pa.array(sizes),
                pa.array(np.add.reduceat((count > 0).astype(np.int64)[some.w], some.starts)),
                pa.array(np.full(len(sizes), model.train_tokens)),
                pa.array(np.add.reduceat((np.log10(count + 1) - base)[some.w], some.starts)),
                pa.array(np.add.reduceat(p[back], some.starts)),
            ]
            own = pa.Table.from_batches(kept).combine_chunks()
            held.clear()
            kept.clear()
            return pa.RecordBatch.from_arrays([*(c.chunk(0) for c in own.columns), *columns], names=[*inner, *made])

        size = 0
        for batch in batches:
            for part in slices(batch, "_text"):
                held.append(tokens(part.column("_text")))
                kept.append(part.select(inner))
                size += len(held[-1][0])
                if size >= SCORE_TOKENS:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    made = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = ", ".join(f"{i} {docs.schema[c].dataType.simpleString()}" for c, i in zip(keep, inner))
    out = picked.mapInArrow(run, f"{kinds}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.select(*[F.col(i).alias(c) for c, i in zip(keep, inner)], *made)
