"""Packing token sequences by vector bin packing.

Every piece of a document demands tokens, one segment and loss-bearing tokens; a sequence has a limit
on each. An open sequence takes the piece with the largest dot product of demand and remaining
capacity among those that fit.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.llm.tokens import TokenEncoder, default_tokenizer, texts_of
from nearfield.llm.words import slices

SEQUENCE = 2048
END_ID = 1
GROUP_TOKENS = 4_000_000  # ids packed together; bounds a task's memory
ROW_BITS = 33


@dataclass(frozen=True)
class Limits:
    tokens: int = SEQUENCE
    segments: int = 256
    loss_tokens: int = SEQUENCE

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss_tokens) < 1:
            raise ValueError("limits must be at least 1")


def pack(tokens: np.ndarray, loss: np.ndarray, limits: Limits) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length) over documents of the given lengths.

    ``loss`` counts the loss-bearing tokens at the end of each document (a prompt comes first). Full
    sequences are cut from long documents at once, as far as the loss limit allows. When no piece fits the rest
    of a sequence, the largest waiting one is cut to fill it. A sequence that another limit or the end closes below
    its token limit is cut into ones whose lengths are powers of two, which need no padding.
    """
    sequences: list[list[tuple[int, int, int]]] = []
    pieces: dict[tuple[int, int], list[tuple[int, int]]] = {}  # (tokens, loss) -> [(document, start)]

    def loss_between(doc: int, start: int, length: int) -> int:
        first = tokens[doc] - loss[doc]
        return max(0, start + length - max(start, first))

    def add(doc: int, start: int, length: int) -> None:
        pieces.setdefault((length, loss_between(doc, start, length)), []).append((doc, start))

    for doc, n in enumerate(tokens.tolist()):
        start = 0
        while n - start >= limits.tokens and loss_between(doc, start, limits.tokens) <= limits.loss_tokens:
            sequences.append([(doc, start, limits.tokens)])
            start += limits.tokens
        while n - start > 0:
            length = min(n - start, limits.tokens)
            over = loss_between(doc, start, length) - limits.loss_tokens
            add(doc, start, length - max(0, over))
            start += length - max(0, over)

    kinds = np.array(sorted(pieces), dtype=np.int64).reshape(-1, 2)
    left = np.array([len(pieces[tuple(k)]) for k in kinds.tolist()], dtype=np.int64)
    scale = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=float)
    while left.any():
        room = np.array([limits.tokens, limits.segments, limits.loss_tokens])
        now: list[tuple[int, int, int]] = []
        while room[0] > 0 and room[1] > 0 and left.any():
            fits = (left > 0) & (kinds[:, 0] <= room[0]) & (kinds[:, 1] <= room[2])
            if fits.any():
                weight = room / scale / scale
                score = kinds[:, 0] * weight[0] + weight[1] + kinds[:, 1] * weight[2]
                at = int(np.argmax(np.where(fits, score, -1.0)))
                doc, start = pieces[tuple(kinds[at].tolist())].pop()
                length, cost = kinds[at].tolist()
                left[at] -= 1
            else:
                at = int(np.flatnonzero(left)[-1])
                doc, start = pieces[tuple(kinds[at].tolist())].pop()
                left[at] -= 1
                whole = int(kinds[at, 0])
                length = min(whole, int(room[0]))
                free = int(tokens[doc] - loss[doc]) - start  # loss-free tokens at the piece's start
                length = min(length, max(0, free) + int(room[2]))
                cost = loss_between(doc, start, length)
                rest = (whole - length, loss_between(doc, start + length, whole - length))
                if rest[0]:
                    pieces.setdefault(rest, []).append((doc, start + length))
                    hit = np.flatnonzero((kinds == rest).all(axis=1))
                    if len(hit):
                        left[hit[0]] += 1
                    else:
                        place = int(np.searchsorted(kinds[:, 0] * (1 << 32) + kinds[:, 1], rest[0] * (1 << 32) + rest[1]))
                        kinds, left = np.insert(kinds, place, rest, axis=0), np.insert(left, place, 1)
                if not length:
                    break
            now.append((doc, start, length))
            room = room - (length, 1, cost)
        total = limits.tokens - int(room[0])
        sequences.extend([now] if total == limits.tokens else _powers_of_two(now, total))
    return sequences


def _powers_of_two(sequence: list[tuple[int, int, int]], total: int) -> Iterator[list[tuple[int, int, int]]]:
    """Cut a sequence into ones whose lengths are the binary digits of its own."""
    waiting = list(reversed(sequence))
    for bit in reversed(range(total.bit_length())):
        room, out = total & (1 << bit), []
        while room:
            doc, start, length = waiting.pop()
            take = min(length, room)
            out.append((doc, start, take))
            if take < length:
                waiting.append((doc, start + take, length - take))
            room -= take
        if out:
            yield out


def pack_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    limits: Limits = Limits(),
    prompt_tokens: str | None = None,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``(key, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    A row's ids are those of its whole text and ``end_id``. All tokens bear loss but the first
    ``prompt_tokens`` (a long column; none by default). Rows are packed in groups of about four
    million tokens inside the task that read them, so nothing is shuffled, memory is bounded, and any
    sequence closed below its token limit is cut to powers of two. Null and
    empty texts have the end id only; rows with a null or repeated key are packed each; an empty
    table gives no rows. ``with_ids`` adds the ids themselves.
    """
    path = tokenizer or default_tokenizer()
    kind = docs.schema[key].dataType.simpleString()
    prompt = F.lit(0) if prompt_tokens is None else F.coalesce(F.col(prompt_tokens), F.lit(0))
    picked = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), prompt.cast("long").alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TokenEncoder(path)
        next_id = TaskContext.get().partitionId() << ROW_BITS
        keys: list = []
        ids: list[np.ndarray] = []
        prompts: list[int] = []

        def flush() -> pa.RecordBatch:
            nonlocal next_id
            tokens = np.array([len(i) for i in ids], dtype=np.int64)
            loss = tokens - np.minimum(tokens, np.maximum(0, prompts))
            rows = []
            for sequence in pack(tokens, loss, limits):
                offset = 0
                for doc, start, length in sequence:
                    rows.append((doc, start, length, next_id, offset))
                    offset += length
                next_id += 1
            doc, start, length, sequence_id, offset = (np.array(c, dtype=np.int64) for c in zip(*rows))
            parts = [ids[d][s : s + n] for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist())]
            crc = [zlib.crc32(p.astype("<u4").tobytes()) for p in parts]
            columns = [
                pa.array([keys[d] for d in doc.tolist()], keys_type), pa.array(start), pa.array(length),
                pa.array(crc, pa.int64()), pa.array(tokens[doc]), pa.array(sequence_id), pa.array(offset),
            ]
            if with_ids:
                columns.append(pa.array([p.astype(np.int64) for p in parts], pa.list_(pa.int64())))
            for held in (keys, ids, prompts):
                held.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        held = 0
        for batch in batches:
            keys_type = batch.column(0).type
            for part in slices(batch, "t"):
                flat, offsets = encoder.encode(texts_of(part.column("t")), end_id)
                for d in range(part.num_rows):
                    keys.append(part.column(0)[d].as_py())
                    ids.append(flat[offsets[d] : offsets[d + 1]])
                prompts.extend(part.column("p").to_pylist())
                held += len(flat)
                if held >= GROUP_TOKENS:
                    yield flush()
                    held = 0
        if keys:
            yield flush()

    names = ["k", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    out = picked.mapInArrow(
        run,
        f"k {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
        + ", ids array<long>" * with_ids,
    )
    return out.withColumnRenamed("k", key)
