"""Language identification by segmentation-marginalised unigrams.

A language is a probability for every piece of a fixed public vocabulary. The probability of a word
is the sum over all ways to cut it into pieces (forward algorithm); pieces never cross words. The
piece probabilities are fitted by expectation-maximisation on word counts of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.llm.words import LOWER, find_words, hash_words, slices, text_bytes
from nearfield.session import cut_lineage

UNKNOWN = "und"
WORD_BYTES = 32  # longer words are scored in runs of so many bytes, which bounds the exponent
CHUNK_WORDS = 6_000
SCORE_WORDS = 1_500  # scored side by side; what their lattice takes stays with the Python worker through later stages
SCALE = 64.0  # per byte; keeps products of probabilities inside a double
MAX_LANGUAGES = 256
_PRIME = np.uint64(0x100000001B3)
_BASIS = np.uint64(0xCBF29CE484222325)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The pieces of a sentencepiece vocabulary as bytes, found by hash; every single byte is one too.

    The word-start mark is a space, as words are scored with a space in front. ``n`` pieces are
    numbered from 0; ``n`` itself stands for no piece.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        known = {bytes([b]) for b in range(256)}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                known.add(model.id_to_piece(i).replace("▁", " ").encode())
        pieces = sorted(p for p in known if len(p) <= WORD_BYTES)
        self.n, self.longest = len(pieces), max(map(len, pieces))
        self.tables: list[tuple[np.ndarray, np.ndarray] | None] = []
        for length in range(1, self.longest + 1):
            ids = np.array([i for i, p in enumerate(pieces) if len(p) == length], dtype=np.int32)
            if not len(ids):
                self.tables.append(None)
                continue
            raw = np.frombuffer(b"".join(pieces[i] for i in ids), dtype=np.uint8).reshape(-1, length)
            h = np.full(len(ids), _BASIS, dtype=np.uint64)
            for at in range(length):
                h = (h ^ raw[:, at]) * _PRIME
            order = np.argsort(h)
            self.tables.append((h[order], ids[order]))

    def lattice(self, words: np.ndarray) -> np.ndarray:
        """For words as rows of bytes (0 behind the end): the piece at [start, length - 1, word]."""
        count, width = words.shape
        out = np.full((width, self.longest, count), self.n, dtype=np.int32)
        for start in range(width):
            h = np.full(count, _BASIS, dtype=np.uint64)
            live = np.flatnonzero(words[:, start])
            for length in range(1, min(self.longest, width - start) + 1):
                live = live[words[live, start + length - 1] != 0]
                if not len(live):
                    break
                h[live] = (h[live] ^ words[live, start + length - 1]) * _PRIME
                if (table := self.tables[length - 1]) is not None:
                    hashes, ids = table
                    at = np.minimum(np.searchsorted(hashes, h[live]), len(hashes) - 1)
                    out[start, length - 1, live] = np.where(hashes[at] == h[live], ids[at], self.n)
        return out


def _matrix(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Words as rows of bytes with a space in front, 0 behind the end (a 0 byte counts as 1)."""
    width = int(lengths.max()) + 1
    out = np.zeros((len(starts), width), dtype=np.uint8)
    out[:, 0] = 32
    for at in range(width - 1):
        live = np.flatnonzero(lengths > at)
        out[live, at + 1] = np.maximum(data[starts[live] + at], 1)
    return out


def _forward(lattice: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Sum over all segmentations up to each place: [place, word, language], scaled."""
    width, longest, count = lattice.shape
    alpha = np.zeros((width + 1, count, p.shape[1]))
    alpha[0] = 1.0
    for start in range(width):
        for length in range(1, min(longest, width - start) + 1):
            ids = lattice[start, length - 1]
            live = np.flatnonzero(ids < len(p) - 1)
            if len(live):
                alpha[start + length, live] += alpha[start, live] * p[ids[live]] * SCALE**length
    return alpha


def word_scores(pieces: Pieces, log_p: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log of each word's probability in every language."""
    p = np.vstack([np.exp(log_p), np.zeros(log_p.shape[1])])
    out = np.empty((len(starts), p.shape[1]))
    order = np.argsort(lengths, kind="stable")
    for at in range(0, len(order), SCORE_WORDS):
        pick = order[at : at + SCORE_WORDS]
        alpha = _forward(pieces.lattice(_matrix(data, starts[pick], lengths[pick])), p)
        whole = alpha[lengths[pick] + 1, np.arange(len(pick))]
        out[pick] = np.log(np.maximum(whole, 1e-300)) - (lengths[pick] + 1)[:, None] * np.log(SCALE)
    return out


def _expected(pieces: Pieces, p: np.ndarray, words: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in the given words of one language."""
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    lengths = np.array([len(w) for w in words])
    starts = np.cumsum(lengths) - lengths
    p = np.append(p, 0.0)
    total = np.zeros(pieces.n)
    order = np.argsort(lengths, kind="stable")
    for at in range(0, len(order), CHUNK_WORDS):
        pick = order[at : at + CHUNK_WORDS]
        lattice = pieces.lattice(_matrix(data, starts[pick], lengths[pick]))
        width, longest, count = lattice.shape
        alpha = _forward(lattice, p[:, None])[:, :, 0]
        beta = np.zeros((width + 1, count))
        beta[lengths[pick] + 1, np.arange(count)] = 1.0
        weight = counts[pick] / np.maximum(alpha[lengths[pick] + 1, np.arange(count)], 1e-300)
        for start in range(width - 1, -1, -1):
            for length in range(1, min(longest, width - start) + 1):
                ids = lattice[start, length - 1]
                live = np.flatnonzero(ids < pieces.n)
                if len(live):
                    step = p[ids[live]] * SCALE**length * beta[start + length, live]
                    beta[start, live] += step
                    total += np.bincount(ids[live], alpha[start, live] * step * weight[live], pieces.n)
    return total


def _cut_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased (A-Z) bytes, word starts and lengths with long words cut, and the document bounds."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, first = find_words(data, offsets)
    runs = np.maximum(1, -(-(ends - starts) // WORD_BYTES))
    if len(runs) and runs.max() > 1:
        whole = np.repeat(np.arange(len(starts)), runs)
        nth = np.arange(len(whole)) - np.repeat(np.cumsum(runs) - runs, runs)
        first = np.append(0, np.cumsum(runs))[first]
        starts, ends = starts[whole] + nth * WORD_BYTES, ends[whole]
    return data, starts, np.minimum(ends - starts, WORD_BYTES), first


@dataclass
class LanguageModel:
    languages: list[str]
    log_p: np.ndarray  # [piece, language]
    vocabulary: str


def fit_languages(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    sample_key: Column | None = None,
    vocabulary: str | None = None,
    docs_per_language: int = 2_000,
    rounds: int = 2,
    smoothing: float = 0.02,
) -> LanguageModel:
    """Fit piece probabilities on about ``docs_per_language`` labelled rows of each language.

    The sample is the documented bound of the fit: rows whose hash of ``sample_key`` (default: the
    text) falls below the share that gives so many rows; all of them where there are fewer. Rows
    with a null label or text are left out. The model has one double per piece and language, at
    most ``MAX_LANGUAGES`` languages.
    """
    spark, vocabulary = docs.sparkSession, vocabulary or default_vocabulary()
    rows = docs.select(
        F.col(lang).alias("l"),
        F.col(text).alias("t"),
        F.pmod(F.xxhash64(F.col(text) if sample_key is None else sample_key), F.lit(1_000_000)).alias("k"),
    ).where("l IS NOT NULL AND t IS NOT NULL")
    counts = {r.l: r.n for r in rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((0, 0)), vocabulary)
    share = F.element_at(
        F.create_map(*[F.lit(x) for name in languages for x in (name, 1e6 * docs_per_language / counts[name])]), F.col("l")
    )
    place = {name: i for i, name in enumerate(languages)}

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                data, starts, lengths, first = _cut_words(part.column("t"))
                label = np.array([place[x] for x in part.column("l").to_pylist()])
                h = hash_words(data, starts, starts + lengths)
                h = h ^ np.repeat(label.astype(np.uint64) << np.uint64(55), np.diff(first))
                _, at, n = np.unique(h, return_index=True, return_counts=True)
                doc = np.searchsorted(first, at, side="right") - 1
                words = [data[s : s + k].tobytes() for s, k in zip(starts[at], lengths[at])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(label[doc], pa.int32()), pa.array(words, pa.binary()), pa.array(n, pa.int64())],
                    names=["l", "word", "n"],
                )

    words = rows.where(F.col("k") < share).select("l", "t").mapInArrow(count_words, "l int, word binary, n long")
    words = cut_lineage(words.groupBy("l", "word").agg(F.sum("n").alias("n")), "words")

    def expect(model: np.ndarray):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            pieces = Pieces(vocabulary)
            for batch in batches:
                for l, part in batch.groupby("l"):
                    found = _expected(pieces, model[:, l], part["word"].tolist(), part["n"].to_numpy(float))
                    used = np.flatnonzero(found)
                    yield pd.DataFrame({"l": l, "piece": used, "uses": found[used]})

        return run

    size = Pieces(vocabulary).n
    p = np.full((size, len(languages)), 1.0 / size)
    for _ in range(rounds):
        uses = words.mapInPandas(expect(p), "l int, piece int, uses double")
        uses = uses.groupBy("l", "piece").agg(F.sum("uses").alias("uses")).toPandas()
        p = np.full(p.shape, smoothing)
        p[uses["piece"], uses["l"]] += uses["uses"]
        p /= p.sum(axis=0)
    return LanguageModel(languages, np.round(np.log(p), 9), vocabulary)


def identify_languages(
    docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``(key, *keep, lang_pred, score)`` for every row, from its whole text alone.

    ``score`` is the posterior of ``lang_pred`` under equal priors, 0 to 1; ties go to the first
    language by name. A null text, one without a letter, and an unfitted model give ``und`` and 0.
    Empty tables give empty results, repeated rows are answered each. Other columns are not read.
    """
    found, names = _identify(docs, model, [key, *(keep or [])], text)
    return found.select(*[F.col(i).alias(c) for c, i in names], "lang_pred", "score")


def _identify(docs: DataFrame, model: LanguageModel, keep: list[str], text: str) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Predictions beside the kept columns, which stand under inner names, and (name, inner name) of each."""
    languages, log_p, vocabulary = model.languages, model.log_p, model.vocabulary
    inner = ["_text" if c == text else f"_c{i}" for i, c in enumerate(keep)]
    picked = docs.select(
        *[F.col(c).alias(i) for c, i in zip(keep, inner)],
        *([] if text in keep else [F.col(text).alias("_text")]),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letters"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(vocabulary) if languages else None
        for batch in batches:
            for part in slices(batch, "_text"):
                n = part.num_rows
                best, score = np.zeros(n, dtype=int), np.zeros(n)
                letters = np.array(part.column("_letters").to_pylist(), dtype=bool)
                if pieces and letters.any():
                    data, starts, lengths, first = _cut_words(part.column("_text"))
                    h = hash_words(data, starts, starts + lengths)
                    _, at, inverse = np.unique(h, return_index=True, return_inverse=True)
                    scores = word_scores(pieces, log_p, data, starts[at], lengths[at])
                    totals = np.zeros((len(starts) + 1, len(languages)))
                    for d in range(n):
                        if first[d] < first[d + 1]:
                            totals[d] = scores[inverse[first[d] : first[d + 1]]].sum(axis=0)
                    totals = totals[:n]
                    best = totals.argmax(axis=1)
                    score = 1.0 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
                known = letters & bool(languages)
                named = [languages[b] if k else UNKNOWN for b, k in zip(best, known)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in inner), pa.array(named), pa.array(np.round(np.where(known, score, 0.0), 6))],
                    names=[*inner, "lang_pred", "score"],
                )

    kinds = ", ".join(f"{i} {docs.schema[c].dataType.simpleString()}" for c, i in zip(keep, inner))
    return picked.mapInArrow(run, f"{kinds}, lang_pred string, score double"), list(zip(keep, inner))


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text", least: float = 0.0) -> DataFrame:
    """The rows of ``docs`` with a language and a score of at least ``least``, all their columns unchanged."""
    found, names = _identify(docs, model, docs.columns, text)
    found = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.select(*[F.col(i).alias(c) for c, i in names])
