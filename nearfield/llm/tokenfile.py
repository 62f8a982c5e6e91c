"""Token-id files: documents' ids in key order, in checksummed blocks of the context-mixing coder.

A file is a magic word, the payloads of its blocks, a compressed footer (block and document tables) and a
trailer that locates the footer. Blocks are coded independently and checked by crc32, before and
after decoding.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nearfield.llm.files import Ranges, open_fs, own_name
from nearfield.llm.idcoder import BLOCK, LANES, checksum, decode_blocks, encode_blocks
from nearfield.llm.tokens import TokenEncoder, default_tokenizer, texts_of
from nearfield.llm.words import slices
from nearfield.operators.ordinals import with_ordinal
from nearfield.session import cut_lineage

MAGIC, VERSION = b"NFID", 1
TRAILER = "<QIII4s"  # footer bytes, footer crc32, nibbles, version, magic
FILE_IDS = 4 * BLOCK * LANES
NO_KEY = np.iinfo(np.int64).min


class TokenFileWriter:
    """Writes one file; ids arrive document by document."""

    def __init__(self, stream, nibbles: int):
        self.stream, self.nibbles = stream, nibbles
        self.kind = np.uint16 if nibbles <= 4 else np.uint32  # held ids take no more than they need
        self.stream.write(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.held = self.ids = 0
        self.blocks: list[tuple[int, int, int, int]] = []  # ids, bytes, crc32 of ids, crc32 of bytes
        self.documents: list[tuple[int, int, int]] = []  # key, has key, ids

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.documents.append((NO_KEY if key is None else key, key is not None, len(ids)))
        self.waiting.append(ids.astype(self.kind))
        self.held += len(ids)
        self.ids += len(ids)
        if self.held >= BLOCK * LANES:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.kind)
        end = len(flat) if last else len(flat) // BLOCK * BLOCK
        self.waiting = [flat[end:].copy()]
        for at in range(0, end, BLOCK * LANES):
            part = flat[at : min(end, at + BLOCK * LANES)]
            blocks = [part[i : i + BLOCK] for i in range(0, len(part), BLOCK)]
            for ids, payload in zip(blocks, encode_blocks(blocks, self.nibbles)):
                self.stream.write(payload)
                self.blocks.append((len(ids), len(payload), checksum(ids), zlib.crc32(payload)))
        self.held = len(flat) - end

    def close(self) -> None:
        self._flush(last=True)
        raw = io.BytesIO()
        np.save(raw, np.array(self.blocks, dtype=np.uint32).reshape(-1, 4))
        np.save(raw, np.array(self.documents, dtype=np.int64).reshape(-1, 3))
        footer = zlib.compress(raw.getvalue(), 6)
        self.stream.write(footer + struct.pack(TRAILER, len(footer), zlib.crc32(footer), self.nibbles, VERSION, MAGIC))
        self.stream.close()


def read_token_file(path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Documents of a file in order; a long document may come in several parts, all but the last cut off
    where a group of blocks ends. The end of a document is marked by ``(key, None)``."""
    size = struct.calcsize(TRAILER)
    with Ranges(path) as file:
        length, crc, nibbles, version, magic = struct.unpack(TRAILER, file.read(file.size - size, size))
        if magic != MAGIC or version != VERSION or file.read(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is no token-id file of version {VERSION}")
        footer = file.read(file.size - size - length, length)
        if zlib.crc32(footer) != crc:
            raise ValueError(f"{path}: the footer is damaged")
        raw = io.BytesIO(zlib.decompress(footer))
        blocks, documents = np.load(raw), np.load(raw)
        at, doc, left = len(MAGIC), 0, int(documents[0, 2]) if len(documents) else 0
        for first in range(0, len(blocks), LANES):
            group = blocks[first : first + LANES].astype(np.int64)
            data = file.read(at, int(group[:, 1].sum()))
            at += len(data)
            ends = np.cumsum(group[:, 1])
            payloads = [data[e - n : e] for e, n in zip(ends.tolist(), group[:, 1].tolist())]
            if [zlib.crc32(p) for p in payloads] != group[:, 3].tolist():
                raise ValueError(f"{path}: a block is damaged")
            found = decode_blocks(payloads, group[:, 0].tolist(), nibbles)
            if [checksum(ids) for ids in found] != group[:, 2].tolist():
                raise ValueError(f"{path}: a block decodes to other ids")
            ids = np.concatenate(found)
            place = 0
            while doc < len(documents) and (place < len(ids) or left == 0):
                part = ids[place : place + left]
                key = int(documents[doc, 0]) if documents[doc, 1] else None
                yield key, part
                place, left = place + len(part), left - len(part)
                if left == 0:
                    yield key, None
                    doc += 1
                    left = int(documents[doc, 2]) if doc < len(documents) else 0


def write_token_files(
    docs: DataFrame,
    folder: str,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = 0,
    id_bits: int | None = None,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode every whole text, append ``end_id`` and write the ids in ascending ``key`` order.

    Returns the files that count: ``(path, start, ids)``, ``start`` being the ids in all files before. Keys are
    long; null keys come first, rows of one key follow each other by hash of the text; null texts
    are empty. An empty table writes no file. A text goes through one sort by ranges of the key. The width of an id
    comes from the vocabulary; a smaller ``id_bits`` raises.
    """
    path = tokenizer or default_tokenizer()
    needed = max(end_id, *Tokenizer.from_file(path).get_vocab().values()).bit_length()
    if needed > min(28, id_bits or 28):
        raise ValueError(f"ids of {needed} bits do not fit {min(28, id_bits or 28)}")
    nibbles = 4 if (id_bits or needed) <= 16 else 7
    order = [F.col("k").asc_nulls_first(), F.xxhash64("t")]
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TokenEncoder(path)
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        task, writer, name = TaskContext.get().partitionId(), None, ""
        done: list[tuple[str, int, int, int]] = []

        def close() -> None:
            writer.close()
            done.append((name, task, len(done), writer.ids))

        for batch in batches:
            for part in slices(batch, "t"):
                flat, offsets = encoder.encode(texts_of(part.column("t")), end_id)
                for d, k in enumerate(part.column("k").to_pylist()):
                    if writer is None:
                        name = own_name(folder, task, len(done), ".ids")
                        writer = TokenFileWriter(fs.open_output_stream(open_fs(name)[1]), nibbles)
                    writer.add(k, flat[offsets[d] : offsets[d + 1]])
                    if writer.ids >= file_ids:
                        close()
                        writer = None
        if writer is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*done) if done else [[]] * 4, (pa.string(), pa.int64(), pa.int64(), pa.int64()))],
            names=["path", "task", "number", "ids"],
        )

    files = cut_lineage(rows.mapInArrow(write, "path string, task long, number long, ids long"), "files")
    return with_ordinal(files, ["task", "number"], "start", weight="ids").select("path", "start", "ids")


def read_token_files(files: DataFrame, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """``(key, start, n_tokens, ids_crc32)`` of every document in the given files; blocks are verified.

    ``ids_crc32`` is of all its ids as little-endian unsigned 32-bit integers; ``with_ids`` adds them.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows: list[tuple] = []
                crc = size = 0
                parts: list[np.ndarray] = []
                for k, ids in read_token_file(path):
                    if ids is not None:
                        crc, size = checksum(ids, crc), size + len(ids)
                        if with_ids:
                            parts.append(ids)
                        continue
                    rows.append((k, start, size, crc) + ((np.concatenate(parts).astype(np.int64),) if with_ids else ()))
                    start, crc, size, parts = start + size, 0, 0, []
                    if len(rows) >= 10_000:
                        yield batch_of(rows)
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        rows.clear()
        return out

    names = ["k", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64()] * 4 + [pa.list_(pa.int64())] * with_ids
    # A given number of partitions is kept; by size alone these few rows would end up in one task.
    spread = files.select("path", "start").repartitionByRange(max(1, files.count()), "path")
    out = spread.mapInArrow(read, "k long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
    return out.withColumnRenamed("k", key)
