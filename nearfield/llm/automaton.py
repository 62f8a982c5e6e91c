"""A generalised suffix automaton over word numbers, streamed in NumPy.

States stand for classes of word sequences with the same ends in the items. A text is read word by word:
a known word follows a transition, else the suffix links shorten the match. The match at a word is
the longest sequence ending there that occurs in an item.
"""

from __future__ import annotations

import io
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LANE = 256


class _Builder:
    """Words are added one at a time; sequences share one root."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        """A state for the shorter members of ``target``'s class, which ``at`` and its suffixes reach."""
        part = self._state(self.length[at] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = part
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = part
            at = self.link[at]
        return part

    def _suffix(self, at: int, word: int) -> int:
        """The state of the sequences one word longer than ``at``."""
        target = self.next[at][word]
        return target if self.length[target] == self.length[at] + 1 else self._split(at, word, target)

    def add(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._suffix(last, word)
        made, at = self._state(self.length[last] + 1, 0, {}), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = made
            at = self.link[at]
        if at >= 0:
            self.link[made] = self._suffix(at, word)
        return made


class Windows:
    """Item windows of one length: the state each state's suffix of that length is in, and its items."""

    def __init__(self, size: int, within: np.ndarray, bounds: np.ndarray, items: np.ndarray):
        self.size, self.within, self.bounds, self.items = size, within, bounds, items


class Automaton:
    """States, transitions sorted by (state, word), the words and the items of the windows."""

    def __init__(self, vocabulary: pa.Array, edges: np.ndarray, targets: np.ndarray, link: np.ndarray,
                 length: np.ndarray, windows: list[Windows]):
        self.vocabulary, self.edges, self.targets = vocabulary, edges, targets
        self.link, self.length, self.windows = link, length, windows
        self.base = max(1, len(vocabulary))
        self.least = min((w.size for w in windows), default=1)
        self.most = max((w.size for w in windows), default=1)

    @classmethod
    def build(cls, items: Iterable[tuple[int, list[bytes], bool]], window: int) -> Automaton:
        """From (item number, words, whole): windows of ``window`` words; a shorter item that is whole is one."""
        builder, known, ends = _Builder(), {}, []
        for item, words, whole in items:
            last, size = 0, len(words)
            for at, word in enumerate(words, 1):
                last = builder.add(last, known.setdefault(word, len(known)))
                if at >= window:
                    ends.append((window, last, item))
            if whole and 0 < size < window:
                ends.append((size, last, item))
        link, length = np.array(builder.link, dtype=np.int64), np.array(builder.length, dtype=np.int64)
        base = max(1, len(known))
        size = np.array([len(e) for e in builder.next], dtype=np.int64)
        words = np.fromiter((w for e in builder.next for w in e), np.int64, int(size.sum()))
        targets = np.fromiter((t for e in builder.next for t in e.values()), np.int64, int(size.sum()))
        edges = np.repeat(np.arange(len(size)), size) * base + words
        order = np.argsort(edges)
        rising = np.argsort(length, kind="stable").tolist()
        windows = []
        for m in sorted({e[0] for e in ends}):
            within, up, long = [-1] * len(link), link.tolist(), length.tolist()
            for s in rising:  # a suffix link leads to a shorter state, so its answer is there already
                if long[s] >= m:
                    within[s] = within[up[s]] if long[up[s]] >= m else s
            within = np.array(within, dtype=np.int64)
            found = np.array([(s, i) for k, s, i in ends if k == m], dtype=np.int64).reshape(-1, 2)
            found = np.unique(np.stack([within[found[:, 0]], found[:, 1]], axis=1), axis=0)
            bounds = np.searchsorted(found[:, 0], np.arange(len(link) + 1))
            windows.append(Windows(m, within, bounds, found[:, 1]))
        return cls(pa.array(list(known), pa.large_binary()), edges[order], targets[order], link, length, windows)

    def dump(self) -> bytes:
        out, arrays = io.BytesIO(), {n: getattr(self, n) for n in ("edges", "targets", "link", "length")}
        for w in self.windows:
            arrays |= {f"{n}{w.size}": getattr(w, n) for n in ("within", "bounds", "items")}
        sizes = self.vocabulary.to_pylist()
        arrays["words"] = np.frombuffer(b"".join(sizes), dtype=np.uint8)
        arrays["cuts"] = np.append(0, np.cumsum([len(w) for w in sizes])).astype(np.int64)
        np.savez(out, sizes=np.array([w.size for w in self.windows], dtype=np.int64), **arrays)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Automaton:
        a = np.load(io.BytesIO(data))
        windows = [Windows(m, a[f"within{m}"], a[f"bounds{m}"], a[f"items{m}"]) for m in a["sizes"].tolist()]
        buffers = [None, pa.py_buffer(a["cuts"]), pa.py_buffer(a["words"])]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(a["cuts"]) - 1, buffers)
        return cls(words, a["edges"], a["targets"], a["link"], a["length"], windows)

    def _step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each state has the transition, and where it leads."""
        keys = state * self.base + word
        at = np.minimum(np.searchsorted(self.edges, keys), len(self.edges) - 1)
        return self.edges[at] == keys, self.targets[at]

    def _runs(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the text can match at least the shortest window: runs in which every word, and every
        pair of neighbours, is a path from the root. Elsewhere matches have at most one word."""
        joined = np.zeros(len(words) + 1, dtype=bool)
        both = np.flatnonzero((words[:-1] >= 0) & (words[1:] >= 0))
        _, one = self._step(np.zeros(len(both), dtype=np.int64), words[both])
        joined[both + 1] = self._step(one, words[both + 1])[0]
        joined[first] = False
        opens = np.flatnonzero((words >= 0) & ~joined[:-1])
        closes = np.flatnonzero((words >= 0) & ~joined[1:]) + 1
        long = closes - opens >= self.least
        return opens[long], closes[long]

    def stream(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, state, match length) of the words that a window may end at.

        ``words`` are vocabulary numbers (-1: unknown) of texts that begin at ``first``. Runs are read
        side by side, long ones in lanes that start ``most - 1`` words early: from there on matches are
        right up to ``most`` words, which is all that windows ask for.
        """
        none = np.zeros(0, dtype=np.int64)
        if not len(self.edges) or not len(words):
            return none, none, none
        opens, closes = self._runs(words, first)
        lanes = -(-(closes - opens) // LANE)
        run = np.repeat(np.arange(len(opens)), lanes)
        number = np.arange(len(run)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        own = opens[run] + number * LANE
        end = np.minimum(own + LANE, closes[run])
        begin = np.maximum(own - (self.most - 1), opens[run])
        order = np.argsort(begin - end, kind="stable")
        own, end, begin = own[order], end[order], begin[order]
        state, size = np.zeros(len(own), dtype=np.int64), np.zeros(len(own), dtype=np.int64)
        out = []
        for t in range(int((end - begin).max(initial=0))):
            active = int(np.searchsorted(begin - end, -t))
            at = begin[:active] + t
            word, left = words[at], np.arange(active)
            while len(left):
                there, target = self._step(state[left], word[left])
                moved = left[there]
                state[moved] = target[there]
                size[moved] += 1
                left = left[~there]
                root = state[left] == 0
                size[left[root]] = 0
                left = left[~root]
                state[left] = self.link[state[left]]
                size[left] = self.length[state[left]]
            kept = (at >= own[:active]) & (size[:active] >= self.least)
            out.append((at[kept], state[:active][kept], size[:active][kept]))
        if not out:
            return none, none, none
        return tuple(np.concatenate(x) for x in zip(*out))

    def matches(self, distinct: pa.Array, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows that occur: (first word, word after the last), and pairs (text, item number)."""
        number = pc.index_in(distinct, value_set=self.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
        words = number.astype(np.int64)[ids]
        place, state, size = self.stream(words, first)
        spans, found = [], []
        for w in self.windows:
            long = np.flatnonzero(size >= w.size)
            node = w.within[state[long]]
            n = w.bounds[node + 1] - w.bounds[node]
            long, node, n = long[n > 0], node[n > 0], n[n > 0]
            spans.append(np.stack([place[long] - w.size + 1, place[long] + 1], axis=1))
            text = np.searchsorted(first, place[long], side="right") - 1
            text, node = np.unique(np.stack([text, node], axis=1), axis=0).T if len(text) else (text, node)
            n = w.bounds[node + 1] - w.bounds[node]
            at = np.repeat(w.bounds[node] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            found.append(np.stack([np.repeat(text, n), w.items[at]], axis=1))
        if not spans:
            return np.zeros((0, 2), dtype=np.int64), np.zeros((0, 2), dtype=np.int64)
        return np.concatenate(spans), np.unique(np.concatenate(found), axis=0)
