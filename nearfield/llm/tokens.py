"""Token ids of whole texts with a public tokenizer, each distinct piece of text encoded once.

Byte-level BPE never merges across the start of ``space + non-space``, so a text may be cut there and
the ids of its pieces joined. Pieces repeat a lot; their ids are kept per Python worker, in a store
of bounded size that later tasks of the worker find again.
"""

from __future__ import annotations

import os
import re
import sys
import types

import numpy as np
import pyarrow as pa

_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # fixed: Unicode White_Space
PIECE = re.compile(f"[{_BLANK}]?[^{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]")
_ODD = re.compile("[" + _BLANK.replace(r"\t-\r ", r"\0\t\x0b-\r") + "]")
_RUN = re.compile(r"[ \n][ \n](?:[ \n]|\Z)")
STORE_PIECES = 400_000  # beyond, the most used half stays; a worker holds them through later stages
BLOCK = 16_384  # pieces whose ids are copied at a time
JOINED = 64  # pieces encoded as one text; one call for each would cost more than their merges
LONG_PIECE = 64  # characters; longer pieces are encoded where they occur and not stored
TAIL = ".,;:!?%#)]}\""  # ASCII punctuation: no id crosses from a letter or digit to it
ALNUM = frozenset(map(chr, [*range(48, 58), *range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x250)]))
_JOINS = re.compile(f"[{_BLANK}][^{_BLANK}]")
_HOME = "_nearfield_piece_store"  # functions travel by value; a module outlives the task


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces_of(text: str) -> list[str]:
    """``PIECE.findall``, in two passes of ``str`` where single spaces and line ends are the only white space."""
    if _ODD.search(text) or _RUN.search(text):
        return PIECE.findall(text)
    found = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
    return found if found[0] else found[1:]


class _Numbers(dict):
    """Numbers of pieces. An unknown piece takes the next one and waits in ``new`` for its ids, or in ``long`` under
    a negative one, which is not kept."""

    def __init__(self, new: list[str], long: dict[str, int]):
        self.new, self.long = new, long

    def __missing__(self, piece: str) -> int:
        if len(piece) > LONG_PIECE:
            return self.long.setdefault(piece, -1 - len(self.long))
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class _Store:
    """Ids of the pieces seen so far: piece -> number, number -> span of one id array."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if type(self.tokenizer.pre_tokenizer).__name__ != "ByteLevel":
            raise ValueError(f"{path} is no byte-level BPE")
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.tail = "" if any(set(TAIL) & set(t) for t in added) else TAIL
        special = {i: len(t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)  # bytes that an id stands for
        for token, i in vocabulary.items():
            self.width[i] = special.get(i, len(token))
        self.clear()

    def clear(self) -> None:
        self.new: list[str] = []
        self.long: dict[str, int] = {}
        self.number = _Numbers(self.new, self.long)
        self.ids = np.zeros(1 << 16, dtype=np.uint16)
        self.starts = np.zeros(1 << 14, dtype=np.int32)  # each piece's span
        self.sizes = np.zeros(1 << 14, dtype=np.int32)
        self.uses = np.zeros(1 << 14, dtype=np.int32)
        self.used = 0

    def count(self, numbers: np.ndarray) -> None:
        """Note which pieces were used."""
        self.uses = _grown(self.uses, len(self.number))
        self.uses[: len(self.number)] += np.bincount(numbers, minlength=len(self.number)).astype(np.int32)

    def shrink(self, size: int) -> None:
        """Keep the ``size`` most used pieces, of those used twice; half of their uses count on."""
        known = list(self.number)  # in the order of their numbers
        self.uses = _grown(self.uses, len(known))
        kept = np.sort(np.argsort(-self.uses[: len(known)], kind="stable")[:size])
        kept = kept[self.uses[kept] > 1]
        starts, sizes, uses, old = self.starts[kept], self.sizes[kept], self.uses[kept] // 2, self.ids
        self.clear()
        self.number.update(zip([known[n] for n in kept.tolist()], range(len(kept))))
        self.starts, self.sizes, self.uses = (_grown(a, len(kept)) for a in (self.starts, self.sizes, self.uses))
        ends = np.cumsum(sizes, dtype=np.int64)
        self._append(old[np.repeat(starts - ends + sizes, sizes) + np.arange(int(sizes.sum()))])
        self.starts[: len(kept)], self.sizes[: len(kept)], self.uses[: len(kept)] = ends - sizes, sizes, uses

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text. The tokenizer cuts added tokens out first, so white space before one ends like a text's."""
        if self.added is None or not self.added.search(text):
            return pieces_of(text)
        parts = self.added.split(text)  # every second one is an added token
        return [p for i, part in enumerate(parts) for p in ([part] if i % 2 else pieces_of(part))]

    def settle(self) -> None:
        """Give all new pieces their ids; a word with punctuation behind it takes those of both."""
        number, new, whole, split = self.number, self.new, [], []
        first = len(number) - len(new)
        for at, piece in enumerate(new):  # grows by the parts found
            word = piece.rstrip(self.tail) if self.tail else piece
            if len(word) < len(piece) and word[-1:] in ALNUM:
                split.append((first + at, number[word], number[piece[len(word) :]]))
            else:
                whole.append(first + at)
        self.starts, self.sizes = (_grown(a, len(number)) for a in (self.starts, self.sizes))
        for at in range(0, len(whole), 50_000):
            self._encode([new[n - first] for n in whole[at : at + 50_000]], whole[at : at + 50_000])
        if split:
            made, word, tail = np.array(split).T
            total = self.sizes[word] + self.sizes[tail]
            ends = np.cumsum(total)
            flat = np.empty(int(ends[-1]), dtype=self.ids.dtype)
            for part, to in ((word, ends - total), (tail, ends - self.sizes[tail])):
                n = self.sizes[part]
                run = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                flat[np.repeat(to, n) + run] = self.ids[np.repeat(self.starts[part], n) + run]
            self.starts[made], self.sizes[made] = self.used + ends - total, total
            self._append(flat)
        new.clear()

    def _append(self, flat: np.ndarray) -> None:
        if len(flat) and flat.max() > np.iinfo(self.ids.dtype).max:
            self.ids = self.ids.astype(np.uint32)
        self.ids = _grown(self.ids, self.used + len(flat))
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)

    def _encode(self, pieces: list[str], numbers: list[int]) -> None:
        """Encode pieces. Those that begin with white space are joined, as no id crosses such a start."""
        joins = [_JOINS.match(p) is not None for p in pieces]
        apart, joined = ([p for p, j in zip(pieces, joins) if j == k] for k in (False, True))
        texts = apart + ["".join(joined[at : at + JOINED]) for at in range(0, len(joined), JOINED)]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        flat = np.concatenate([np.array(e.ids, dtype=np.uint32) for e in encoded])
        sizes = np.fromiter((len(p.encode()) for p in apart + joined), dtype=np.int64, count=len(pieces))
        ends = np.searchsorted(np.cumsum(self.width[flat]), np.cumsum(sizes)) + 1
        own = np.array(numbers)[np.argsort(np.array(joins), kind="stable")]
        self.sizes[own] = np.diff(ends, prepend=0)
        self.starts[own] = self.used + ends - self.sizes[own]
        self._append(flat)


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])


class TokenEncoder:
    """Encodes texts with the tokenizer file at ``path``; create one per task."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        home = sys.modules.setdefault(_HOME, types.ModuleType(_HOME))
        if not hasattr(home, path):
            setattr(home, path, _Store(path))
        self.store: _Store = getattr(home, path)

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids (unsigned 32-bit), ``end_id`` after each text, and the n + 1 offsets of the texts."""
        store = self.store
        if store.new:  # not settled: the task before failed
            store.clear()
        if len(store.number) > STORE_PIECES:
            store.shrink(STORE_PIECES // 2)
        look, parts = store.number.__getitem__, []
        for text in texts:  # one text at a time, as its pieces are still in the processor's cache
            found = store.pieces(text)
            parts.append(np.fromiter(map(look, found), dtype=np.int32, count=len(found)))
        counts = [len(p) for p in parts]
        number = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        if store.new:
            store.settle()
        rare = [np.array(store.tokenizer.encode(p, add_special_tokens=False).ids, dtype=np.uint32) for p in store.long]
        store.long.clear()

        known = np.maximum(number, 0)
        store.count(known)
        starts, lengths = store.starts.take(known), store.sizes.take(known)
        for i, ids in enumerate(rare):
            lengths[number == -1 - i] = len(ids)
        # One more length per text, for its end.
        bounds = np.append(0, np.cumsum(counts)).astype(np.int64)
        places = np.append(0, np.cumsum(lengths, dtype=np.int64))
        offsets = places[bounds] + np.arange(len(texts) + 1)
        out = np.empty(int(offsets[-1]), dtype=np.uint32)
        stored = number >= 0 if rare else slice(None)
        n = lengths[stored]
        before = np.cumsum(n, dtype=np.int64) - n
        run = starts[stored] - before
        ids = np.empty(int(n.sum()), dtype=store.ids.dtype)
        for at in range(0, len(n), BLOCK):  # a block's arrays stay in the processor's cache
            lo, size = int(before[at]), int(n[at : at + BLOCK].sum())
            from_store = np.repeat(run[at : at + BLOCK], n[at : at + BLOCK])
            from_store += np.arange(lo, lo + size)
            store.ids.take(from_store, out=ids[lo : lo + size], mode="clip")
        if rare:
            target = places[:-1] + np.repeat(np.arange(len(texts)), counts)
            out[np.repeat(target[stored] - before, n) + np.arange(len(ids))] = ids
        else:  # a text's ids lie together
            for i, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), (offsets[1:] - 1).tolist())):
                out[lo:hi] = ids[lo - i : hi - i]
        for at in np.flatnonzero(number < 0).tolist():
            ids = rare[-1 - number[at]]
            out[target[at] : target[at] + len(ids)] = ids
        out[offsets[1:] - 1] = end_id
        return out, offsets


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of a text column; null counts as empty."""
    return ["" if t is None else t for t in column.to_pylist()]
