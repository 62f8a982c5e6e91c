"""WARC records in ZIP packages: written by tasks, found through the ZIP directory, read by ranges.

A package holds stored members only: ``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.cdx`` (offset and length of every record), so any record can be read without
unpacking the rest.
"""

from __future__ import annotations

import hashlib
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.llm.files import Ranges, open_fs, own_name
from nearfield.llm.zipranges import members
from nearfield.operators.ordinals import join_sized
from nearfield.session import cut_lineage

LEAST_BYTES = 100  # smaller payloads are always stored
PACKAGE_BYTES = 256 << 20
READ_BYTES = 4 << 20
RUNS_PER_TASK = 4
DATE = "1970-01-01T00:00:00Z"  # pages carry no time; one value keeps reruns equal
RECORD = "urn:nearfield:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"


def _header(text: str) -> str:
    """A header value on one line: white space and control characters are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit keeps the HTTP head, with the length of the payload it leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{RECORD}{'' if page is None else page}>",
        f"WARC-Date: {DATE}",
        *([] if url is None else [f"WARC-Target-URI: {_header(url)}"]),
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{RECORD}{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (lower-case names), HTTP head and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(fields["content-length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    return fields, http, payload


def write_packages(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = LEAST_BYTES,
    package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Write one record per row into packages below ``folder``; returns ``(path, records)`` of each.

    Of rows with equal payloads of at least ``least_bytes``, that with the smallest key is a response
    and the others revisit it; all others are responses. A null payload is empty; a null url leaves
    the field out; a null key is the last of its group. An empty table writes nothing.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("page"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.encode(F.col(payload), "UTF-8"), F.lit(b"")).alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= least_bytes)
    first = large.groupBy("digest").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = join_sized(rows, first.select("digest", "first"), ["digest"], "left")
    refers = F.when((F.octet_length("payload") >= least_bytes) & ~F.col("page").eqNullSafe(F.col("first")), F.col("first"))
    rows = rows.select("page", "url", "payload", "digest", refers.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        task, number, package = TaskContext.get().partitionId(), 0, None
        done: list[tuple[str, int]] = []

        def close() -> None:
            data.close()
            package.writestr(INDEX, "".join(f"{a} {n}\n" for a, n in index))
            package.close()
            stream.close()
            done.append((name, len(index)))

        for batch in batches:
            for i in range(batch.num_rows):
                page, at, body, digest, refers_to = (c[i].as_py() for c in batch.columns)
                if package is None:
                    name = own_name(folder, task, number, ".zip")
                    stream = fs.open_output_stream(open_fs(name)[1])
                    package = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED)
                    data = package.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
                    index, offset = [], 0
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                packed = packer.compress(record(page, at, body, digest, refers_to)) + packer.flush()
                data.write(packed)
                index.append((offset, len(packed)))
                offset += len(packed)
                if offset >= package_bytes:
                    close()
                    package, number = None, number + 1
        if package is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "records"]
        )

    return cut_lineage(rows.mapInArrow(write, "path string, records long"), "packages")


def locate_records(packages: DataFrame, read_bytes: int = READ_BYTES) -> DataFrame:
    """``(path, start, lengths)``: runs of neighbouring records of about ``read_bytes`` in every package.

    Only the ZIP directory, local headers and indexes are read. A package may hold several archives,
    each with an index of the same name.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with Ranges(path) as file:
                    found = {m.name: m for m in members(file)}
                    for name, archive in found.items():
                        if not (name.startswith("archive/") and name.endswith(".warc.gz")):
                            continue
                        stem = name.removeprefix("archive/").removesuffix(".warc.gz")
                        index = found.get(f"indexes/{stem}.cdx") or found.get(INDEX)
                        if index is None:
                            raise ValueError(f"{path} has no index for {name}")
                        begin = archive.start(file)
                        starts, runs, held = [], [], 0
                        for offset, length in _index_lines(file, index.start(file), index.size):
                            if not runs or held >= read_bytes or starts[-1] + held != begin + offset:
                                starts.append(begin + offset)
                                runs.append([])
                                held = 0
                            runs[-1].append(length)
                            held += length
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path] * len(starts), pa.string()), pa.array(starts, pa.int64()), pa.array(runs, pa.list_(pa.int64()))],
                            names=["path", "start", "lengths"],
                        )

    return packages.select("path").mapInArrow(locate, "path string, start long, lengths array<long>")


def _index_lines(file: Ranges, start: int, size: int) -> Iterator[tuple[int, int]]:
    held = b""
    for at in range(0, size, 1 << 20):
        held += file.read(start + at, min(1 << 20, size - at))
        *lines, held = held.split(b"\n")
        for line in lines:
            offset, length = line.split()
            yield int(offset), int(length)


def read_packages(packages: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record: ``(page_id, url, record_type, payload_bytes, payload_digest, refers_to)``.

    Digest and length of a response are taken from its payload, and must agree with the header;
    those of a revisit, which has none, are the header's. ``with_payload`` adds the bytes.
    """

    def number(text: str | None) -> int | None:
        digits = text.strip("<>").removeprefix(RECORD) if text else ""
        return int(digits) if digits else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                with Ranges(path) as file:
                    raw = file.read(start, sum(lengths))
                out, at = [], 0
                for length in lengths:
                    fields, http, payload = parse(zlib.decompress(raw[at : at + length], 31))
                    at += length
                    digest = fields["warc-payload-digest"].removeprefix("sha256:")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    kind = fields["warc-type"]
                    if kind == "response" and (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
                        raise ValueError(f"{path}: payload and header of {fields['warc-record-id']} differ")
                    out.append((
                        number(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, size, digest,
                        number(fields.get("warc-refers-to")), payload if kind == "response" else None,
                    ))
                columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"] + ["payload"] * with_payload
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()] + [pa.binary()] * with_payload
    kinds = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    runs = cut_lineage(locate_records(packages), "runs")
    # A given number of partitions is kept; by size alone these few rows would end up in one task.
    spread = runs.repartitionByRange(max(1, -(-runs.count() // RUNS_PER_TASK)), "path", "start")
    return spread.mapInArrow(read, kinds + ", payload binary" * with_payload)
