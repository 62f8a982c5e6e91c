"""The directory of a ZIP file, from byte ranges; stored members can then be read in place.

Follows the end record, the ZIP64 end record and locator, and the ZIP64 extra field of the public ZIP
application note.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

from nearfield.llm.files import Ranges

# Fixed values of the format.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
STORED, ENCRYPTED = 0, 1
READ = 1 << 20


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    flags: int
    size: int
    header: int  # offset of the local header

    def start(self, file: Ranges) -> int:
        """Offset of the data of a stored member."""
        if self.method != STORED or self.flags & ENCRYPTED:
            raise ValueError(f"{self.name} is compressed or encrypted; only stored members can be read in place")
        head = file.read(self.header, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header for {self.name}")
        name, extra = struct.unpack("<HH", head[26:30])
        return self.header + 30 + name + extra


def _directory(file: Ranges) -> tuple[int, int]:
    """Start and size of the central directory."""
    length = min(file.size, 22 + FULL16)
    tail = file.read(file.size - length, length)
    at = len(tail)
    while (at := tail.rfind(END, 0, at)) >= 0:  # the last one whose comment ends with the file
        if at + 22 <= len(tail) and at + 22 + struct.unpack("<H", tail[at + 20 : at + 22])[0] == len(tail):
            break
    if at < 0:
        raise ValueError("not a ZIP file: no end record")
    disk, first, here, total, size, start = struct.unpack("<HHHHII", tail[at + 4 : at + 20])
    end = file.size - length + at
    if FULL16 in (disk, first, here, total) or FULL32 in (size, start):
        locator = file.read(end - 20, 20) if end >= 20 else b""
        if locator[:4] == LOCATOR64:
            (where,) = struct.unpack("<Q", locator[8:16])
            record = file.read(where, 56)
            if record[:4] != END64:
                raise ValueError("the ZIP64 end record is not where its locator says")
            size, start = struct.unpack("<QQ", record[40:56])
            end = where
    if start + size > end:
        raise ValueError("the central directory lies outside the file")
    return start, size


def members(file: Ranges) -> Iterator[Member]:
    """All entries of the central directory, read a megabyte at a time."""
    at, left = _directory(file)
    held = b""
    while left or held:
        if left and len(held) < 46 + 3 * FULL16:
            step = min(left, READ)
            held += file.read(at, step)
            at, left = at + step, left - step
            continue
        if held[:4] != ENTRY:
            raise ValueError("broken central directory")
        flags, method = struct.unpack("<HH", held[8:12])
        size, whole, name, extra, comment = struct.unpack("<IIHHH", held[20:34])
        (header,) = struct.unpack("<I", held[42:46])
        fields = held[46 + name : 46 + name + extra]
        while len(fields) >= 4:
            tag, length = struct.unpack("<HH", fields[:4])
            if tag == 1:  # the values that did not fit, in this order
                wide = iter(struct.unpack(f"<{length // 8}Q", fields[4 : 4 + length // 8 * 8]))
                whole = next(wide) if whole == FULL32 else whole
                size = next(wide) if size == FULL32 else size
                header = next(wide) if header == FULL32 else header
            fields = fields[4 + length :]
        yield Member(held[46 : 46 + name].decode("utf-8", "replace"), method, flags, size, header)
        held = held[46 + name + extra + comment :]
