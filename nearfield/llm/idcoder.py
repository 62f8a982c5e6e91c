"""Adaptive context-mixing range coder for token ids, for many independent blocks in lockstep.

Each block starts from an empty model. Order 2 and order 1 (hashed contexts of the last ids) each
predict one id with a confidence; order 0 is an adaptive distribution over the id's nibbles. An id is
coded as "order 2 was right", "order 1 was right" or neither, with weights that adapt for each pair of
confidences, and in the last case by its nibbles. All arithmetic is on integers, so files decode
alike everywhere. NumPy runs one step of all blocks at a time; blocks do not touch each other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np

BLOCK = 4_096  # ids
LANES = 2_048  # blocks in lockstep
SCALE, RATE, LEAST = 15, 4, 24  # cumulative counts end at 2**15; speed of adaptation; smallest share
SLOTS1, SLOTS2 = 11, 12  # bits of the context tables
CONFIDENT = 7
LOW32 = np.uint64(1 << 32)
TOP = np.uint64(1 << 48)
_ONES = np.uint64(0x0101010101010101)
_U16, _U48, _SCALE = np.uint64(16), np.uint64(48), np.uint64(SCALE)
_HASH1, _HASH2 = np.array([[0x9E3779B1], [0x85EBCA6B]], dtype=np.uint32), np.uint32(0xC2B2AE35)
_SHIFTS = np.array([[32 - SLOTS1], [32 - SLOTS2]], dtype=np.uint32)
_U1, _U3, _U7 = np.uint32(1), np.uint32(3), np.uint32(7)
WHOLE = -1 << SCALE  # 2**15 in the 16 bits of a count, which bounds read without their sign


def _steps(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of ``n`` symbols' first cumulative counts, and what each symbol pulls them towards."""
    whole = 1 << SCALE
    start = np.array([whole * i // n for i in range(1, n)] + [WHOLE], dtype=np.int16)
    room = whole - n * LEAST
    pull = [[LEAST * i + (room if i > s else 0) for i in range(1, n)] + [WHOLE] for s in range(n)]
    return start, np.array(pull, dtype=np.int16)  # below 2**15, as are all differences, so 16 bits do


START16, PULL16 = _steps(16)
START3, PULL3 = (np.insert(a, 2, 0, axis=-1) for a in _steps(3))  # four numbers, moved as one


class _Model:
    """The adaptive state of ``lanes`` blocks. Rows of counts are moved whole, as single items.

    What all blocks keep for one context lies together: frequent contexts are so to many blocks at a time, and share pages.
    """

    def __init__(self, lanes: int, nibbles: int):
        self.nibbles = nibbles
        self.lanes = lanes
        self.slots = np.zeros((lanes << SLOTS1) + (lanes << SLOTS2), dtype=np.uint32)  # order 1, then 2: id << 3 | confidence
        self.first = np.stack([np.arange(lanes), np.arange(lanes) + (lanes << SLOTS1)])
        self.weights = np.tile(START3, lanes * 128).view(np.uint64)
        rows = [min(16**i, 256) for i in range(nibbles)]  # a nibble's contexts: the two nibbles before it, if there are
        self.places = lanes * np.array([sum(rows[:i]) for i in range(nibbles)])[:, None]
        self.zero = np.tile(START16, lanes * sum(rows)).view("V32")
        self.last = np.zeros(lanes, dtype=np.uint32)
        self.before = np.zeros(lanes, dtype=np.uint32)

    def predict(self, n: int) -> None:
        """Look up both predictions of the first ``n`` blocks."""
        h = self.last[:n] * _HASH1
        h[1] += self.before[:n] * _HASH2
        h >>= _SHIFTS
        self.at = h * np.int64(self.lanes)
        self.at += self.first[:, :n]
        self.state = self.slots.take(self.at)
        self.known = self.state >> _U3
        self.sure = self.state & _U7
        pair = (self.sure[1] << _U3) + self.sure[0]
        pair += (self.known[0] == self.known[1]).view(np.uint8) << np.uint8(6)
        self.wat = pair * np.int64(self.lanes)
        self.wat += self.first[0, :n]
        self.w = self.weights.take(self.wat).view(np.int16).reshape(n, 4)

    def learn(self, n: int, ids: np.ndarray, slot: np.ndarray) -> None:
        pull = PULL3.take(slot, axis=0)
        pull -= self.w
        pull >>= RATE
        pull += self.w
        self.weights[self.wat] = pull.view(np.uint64).reshape(-1)
        state, sure = self.state, self.sure
        wrong = self.known != ids
        down = (sure + _U1) >> _U1
        new = np.where(wrong, state - down, state + (sure < CONFIDENT))
        wrong &= sure <= _U1
        np.copyto(new, (ids << _U3) | _U1, where=wrong)
        self.slots[self.at.reshape(-1)] = new.reshape(-1)
        self.before[:n] = self.last[:n]
        self.last[:n] = ids

    def nibbles_seen(self, at: np.ndarray, counts: np.ndarray, symbol: np.ndarray) -> None:
        """Adapt the rows at ``at``, which hold ``counts``, to their symbols."""
        pull = PULL16.take(symbol, axis=0)
        pull -= counts
        pull >>= RATE
        pull += counts
        np.put(self.zero, at, pull.reshape(-1).view("V32"))


def _bounds(counts: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and share of a symbol in rows of ends of cumulative counts."""
    flat = counts.reshape(-1).view(np.uint16)
    at = np.arange(0, len(flat), counts.shape[1]) + symbol
    end = flat.take(at)
    at -= 1
    start = flat.take(at, mode="wrap") & np.uint16((1 << SCALE) - 1)  # before a row lies the whole of another
    end -= start
    return start.astype(np.uint64), end.astype(np.uint64)


def _slot_bounds(w: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and share of one of three slots in rows ``end, end, 0, whole``."""
    start = np.where(slot == 0, 0, np.where(slot == 1, w[:, 0], w[:, 1]))
    end = np.where(slot == 0, w[:, 0], np.where(slot == 1, w[:, 1], WHOLE))
    return start.astype(np.uint64), (end - start).view(np.uint16).astype(np.uint64)


def _settle(low: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shift out the top 16 bits of intervals that are too small; tells each time which, and their low ends."""
    small = np.flatnonzero(size < LOW32)
    while len(small):
        at, part = low[small], size[small]
        open_ = (at ^ (at + part)) >= TOP  # the top bits are not settled: give up what lies beyond
        if open_.any():
            part = np.where(open_, (~at + np.uint64(1)) & (LOW32 - np.uint64(1)), part)
        yield small, at
        part <<= _U16
        low[small], size[small] = at << _U16, part
        small = small[part < LOW32]


class _Encoder:
    def __init__(self, lanes: int, steps: int, nibbles: int):
        self.low = np.zeros(lanes, dtype=np.uint64)
        self.range = np.full(lanes, TOP, dtype=np.uint64)
        # Lanes side by side: they fill up at about one pace, so memory is touched as far as the longest payload only.
        self.words = np.zeros((steps * (nibbles + 1) + 8, lanes), dtype=np.uint16)
        self.flat = self.words.reshape(-1)
        self.next = np.arange(lanes)  # place of each lane's next word

    def put(self, lanes: np.ndarray | None, low: np.ndarray, size: np.ndarray, start: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Narrow intervals to a symbol each, ``low`` in place; returns their sizes."""
        step = size >> _SCALE
        low += step * start
        step *= share
        for small, at in _settle(low, step):
            who = small if lanes is None else lanes[small]
            place = self.next[who]
            self.flat[place] = (at >> _U48).astype(np.uint16)
            self.next[who] = place + len(self.low)
        return step

    def finish(self) -> list[bytes]:
        used, rows = self.next // len(self.low), np.arange(len(self.low))
        for shift in (48, 32, 16, 0):
            self.words[used, rows] = (self.low >> np.uint64(shift)).astype(np.uint16)
            used += 1
        words = np.ascontiguousarray(self.words[: used.max()].T, dtype="<u2")
        return [w[:n].tobytes() for w, n in zip(words, used.tolist())]


class _Decoder:
    def __init__(self, payloads: list[bytes]):
        words = [np.frombuffer(p, dtype="<u2") for p in payloads]
        self.words = np.zeros((max(map(len, words)) + 8, len(words)), dtype=np.uint16)  # lanes side by side, as they were written
        for lane, w in enumerate(words):
            self.words[: len(w), lane] = w
        self.low = np.zeros(len(words), dtype=np.uint64)
        self.range = np.full(len(words), TOP, dtype=np.uint64)
        self.code = np.zeros(len(words), dtype=np.uint64)
        for i in range(4):
            self.code = (self.code << _U16) | self.words[i].astype(np.uint64)
        self.flat = self.words.reshape(-1)
        self.next = np.arange(4 * len(words), 5 * len(words))

    def take(self, lanes: np.ndarray | None, low: np.ndarray, step: np.ndarray, code: np.ndarray, start: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Narrow intervals to the symbols found, ``low`` and ``code`` in place; returns their sizes."""
        low += step * start
        size = step * share
        for small, _ in _settle(low, size):
            who = small if lanes is None else lanes[small]
            place = self.next[who]
            code[small] = (code[small] << _U16) | self.flat.take(place, mode="clip")
            self.next[who] = place + len(self.low)
        return size


def _nibbles(ids_bits: int) -> int:
    return 4 if ids_bits <= 16 else 7


def _symbol(counts: np.ndarray, past: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Symbols of rows of counts, given how far the code lies in each interval and the size of a count."""
    value = past.view(np.int64).astype(np.float64)  # exact, as both are below 2**48 and the quotient is rounded down
    value /= step.view(np.int64).astype(np.float64)
    np.minimum(value, (1 << SCALE) - 1, out=value)
    below = (counts <= value.astype(np.int16)[:, None]).view(np.uint64)  # sixteen 0/1 bytes, the last 1; a product adds up their bytes
    return (((below[:, 0] + below[:, 1]) * _ONES) >> np.uint64(56)).view(np.int64) - 1


def _widths(lengths: np.ndarray) -> Iterator[tuple[int, range]]:
    """How many blocks, of falling lengths, are coded side by side, and in which steps."""
    ends = np.unique(lengths)
    for first, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
        yield int((lengths >= end).sum()), range(first, end)


def encode_blocks(blocks: list[np.ndarray], nibbles: int) -> list[bytes]:
    """Payloads of blocks of ids, each decodable alone. Ids need ``nibbles`` * 4 bits, 28 at most."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    lengths = np.array([len(blocks[i]) for i in order])
    table = np.zeros((lengths[0], len(blocks)), dtype=np.uint16 if nibbles <= 4 else np.uint32)
    for column, i in enumerate(order):
        table[: len(blocks[i]), column] = blocks[i]
    model, coder = _Model(len(blocks), nibbles), _Encoder(len(blocks), int(lengths[0]), nibbles)
    shifts = 4 * np.arange(nibbles - 1, -1, -1)[:, None]
    for n, steps in _widths(lengths):
        low, size = coder.low[:n], coder.range[:n]
        for t in steps:
            ids = table[t, :n].astype(np.uint32)
            model.predict(n)
            slot = np.where(model.known[1] == ids, 0, np.where(model.known[0] == ids, 1, 2))
            size[:] = coder.put(None, low, size, *_slot_bounds(model.w, slot))
            missed = np.flatnonzero(slot == 2)
            if len(missed):
                prefix = ids[missed].astype(np.int64) >> shifts  # a row for each nibble
                symbol = prefix & 15
                at = ((prefix >> 4) & 255) * model.lanes
                at += missed
                at += model.places
                at, symbol = at.reshape(-1), symbol.reshape(-1)
                counts = model.zero.take(at).view(np.int16).reshape(-1, 16)
                start, share = (x.reshape(nibbles, -1) for x in _bounds(counts, symbol))
                model.nibbles_seen(at, counts, symbol)
                part, rest = low[missed], size[missed]
                for i in range(nibbles):
                    rest = coder.put(missed, part, rest, start[i], share[i])
                low[missed], size[missed] = part, rest
            model.learn(n, ids, slot)
    out: list[bytes] = [b""] * len(blocks)
    for i, payload in zip(order, coder.finish()):
        out[i] = payload
    return out


def decode_blocks(payloads: list[bytes], lengths: list[int], nibbles: int) -> list[np.ndarray]:
    """The ids of blocks, from their payloads and lengths."""
    order = sorted(range(len(payloads)), key=lambda i: -lengths[i])
    sizes = np.array([lengths[i] for i in order])
    table = np.zeros((sizes[0], len(payloads)), dtype=np.uint16 if nibbles <= 4 else np.uint32)
    model, coder = _Model(len(payloads), nibbles), _Decoder([payloads[i] for i in order])
    for n, steps in _widths(sizes):
        low, size, code = coder.low[:n], coder.range[:n], coder.code[:n]
        for t in steps:
            model.predict(n)
            step, past = size >> _SCALE, code - low
            ends = model.w[:, :2].astype(np.uint64)
            slot = (past >= step * ends[:, 0]).view(np.int8) + (past >= step * ends[:, 1]).view(np.int8)
            size[:] = coder.take(None, low, step, code, *_slot_bounds(model.w, slot))
            ids = np.where(slot == 0, model.known[1], model.known[0])
            missed = np.flatnonzero(slot == 2)
            if len(missed):
                at, counts = np.empty((nibbles, len(missed)), np.int64), np.empty((nibbles, len(missed), 16), np.int16)
                symbols, value, own = np.empty((nibbles, len(missed)), np.int64), np.zeros(len(missed), np.int64), missed + model.places
                part, rest, codes = low[missed], size[missed], code[missed]
                for i in range(nibbles):
                    np.add(own[i], (value & 255) * model.lanes, out=at[i])
                    model.zero.take(at[i], out=counts[i].reshape(-1).view("V32"), mode="clip")
                    step = rest >> _SCALE
                    symbols[i] = _symbol(counts[i], codes - part, step)
                    rest = coder.take(missed, part, step, codes, *_bounds(counts[i], symbols[i]))
                    value <<= 4
                    value |= symbols[i]
                low[missed], size[missed], code[missed] = part, rest, codes
                model.nibbles_seen(at.reshape(-1), counts.reshape(-1, 16), symbols.reshape(-1))
                ids[missed] = value
            model.learn(n, ids, slot)
            table[t, :n] = ids
    del model, coder
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(payloads)
    for row, i in enumerate(order):
        out[i] = table[: lengths[i], row].astype(np.uint32)
    return out


def checksum(ids: np.ndarray, before: int = 0) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes(), before)
