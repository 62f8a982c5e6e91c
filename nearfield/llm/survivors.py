"""Survivor-coalescence Viterbi over the states of a repaired conversation.

Every state keeps its cheapest edits, ties to the least text, as a path in a tree of back pointers. Nodes count
what refers to them; a branch goes when its last survivor does, and what all survivors share is handed out and
forgotten. So memory holds the undecided suffixes only, and those are whole when ties compare them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

# Role initials must read (s?(ua)+)?: nothing yet, after s, after u, after a.
STATES = range(4)
ACCEPTING = (0, 3)
KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FORCED = (2, 2, 3, 2)  # the state an inserted or reroled turn leads to
ROLE = {2: "user", 3: "assistant"}
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
# (state, other): what the other can lose at most by doing whatever the state does later. It may insert the turn that is
# missing, or delete a first s it has no place for.
BEHIND = {(0, 1): 2 * INSERT, (0, 2): INSERT + DELETE, (0, 3): DELETE, (1, 2): INSERT, (1, 3): 0, (2, 3): INSERT, (3, 2): INSERT}
FINE, BLANK, DUPLICATE, CUT = range(4)


class _Node:
    __slots__ = ("parent", "text", "tag", "depth", "children", "held")

    def __init__(self, parent: _Node | None, text: str, tag: object):
        self.parent, self.text, self.tag = parent, text, tag
        self.depth = parent.depth + 1 if parent else 0
        self.children: set[_Node] = set()
        self.held = 0  # survivors that end here


class Survivors:
    """Paths from ``start`` to every state; ``emit(text, tag)`` gets each edit once it is decided."""

    def __init__(self, start: int, emit: Callable[[str, object], None]):
        self.emit = emit
        self.base = _Node(None, "", None)
        self.base.held = 1
        self.best: dict[int, tuple[int, _Node]] = {start: (0, self.base)}

    def _release(self, node: _Node) -> None:
        node.held -= 1
        while not node.held and not node.children and node.parent is not None:
            parent = node.parent
            parent.children.discard(node)
            node.parent, node = None, parent

    @staticmethod
    def _below(node: _Node, depth: int, found: list[str]) -> _Node:
        while node.depth > depth:
            found.append(node.text)
            node = node.parent
        return node

    def _less(self, a: tuple[_Node, str], b: tuple[_Node, str]) -> bool:
        """Whether path ``a`` reads less than ``b``; both are compared from where they part."""
        x, y = [a[1]], [b[1]]
        depth = min(a[0].depth, b[0].depth)
        p, q = self._below(a[0], depth, x), self._below(b[0], depth, y)
        while p is not q:
            x.append(p.text)
            y.append(q.text)
            p, q = p.parent, q.parent
        return "".join(reversed(x)) < "".join(reversed(y))

    def _better(self, found: tuple[int, _Node, str, object], old: tuple[int, _Node, str, object] | None) -> bool:
        if old is None or found[0] != old[0]:
            return old is None or found[0] < old[0]
        return self._less(found[1:3], old[1:3])

    def _grow(self, parent: _Node, text: str, tag: object) -> _Node:
        node = _Node(parent, text, tag)
        parent.children.add(node)
        node.held = 1
        return node

    def insert(self) -> None:
        """Allow inserted turns here, any number of them."""
        changed = True
        while changed:
            changed = False
            for state in list(self.best):
                (cost, node), to = self.best[state], FORCED[state]
                old = self.best.get(to)
                if self._better((cost + INSERT, node, "I", None), old and (old[0], old[1], "", None)):
                    self.best[to] = cost + INSERT, self._grow(node, "I", None)
                    if old:
                        self._release(old[1])
                    changed = True

    def advance(self, moves: Iterable[tuple[int, int, int, str, object]]) -> None:
        """Take one step of every (state, next state, cost, text, tag); states without one are left."""
        found: dict[int, tuple[int, _Node, str, object]] = {}
        for state, to, cost, text, tag in moves:
            if (from_ := self.best.get(state)) is not None:
                offer = (from_[0] + cost, from_[1], text, tag)
                if self._better(offer, found.get(to)):
                    found[to] = offer
        old = self.best
        self.best = {to: (cost, self._grow(node, text, tag)) for to, (cost, node, text, tag) in found.items()}
        for _, node in old.values():
            self._release(node)
        self._prune()
        self._settle()

    def _prune(self) -> None:
        """Give up states that another beats whatever comes, ties not included; else those of a lone start would never be."""
        costs = {state: cost for state, (cost, _) in self.best.items()}
        for (state, other), most in BEHIND.items():
            if state in costs and other in costs and costs[other] + most < costs[state] and state in self.best:
                self._release(self.best.pop(state)[1])

    def row(self, initial: str, fault: int) -> None:
        """Insert at will, then keep, rerole or delete one turn."""
        self.insert()
        moves = []
        extra = TRUNCATED if fault == CUT else 0
        for state in self.best:
            moves.append((state, state, DELETE, "D", None))
            if fault in (FINE, CUT):
                moves.append((state, FORCED[state], REROLE + extra, "R", None))
                if initial in KEEP[state]:
                    moves.append((state, KEEP[state][initial], extra, "K", None))
        self.advance(moves)

    def _settle(self) -> None:
        """Hand out what all survivors have in common."""
        while len(self.base.children) == 1 and not self.base.held:
            (self.base,) = self.base.children
            self.base.parent = None
            self.emit(self.base.text, self.base.tag)

    def rest(self, state: int) -> list[tuple[str, object]]:
        """The undecided steps of the path to ``state``."""
        out, node = [], self.best[state][1]
        while node is not self.base:
            out.append((node.text, node.tag))
            node = node.parent
        return out[::-1]

    def finish(self) -> tuple[int, list[tuple[str, object]]]:
        """Cost and undecided steps of the best whole repair."""
        self.insert()
        best = None
        for state in ACCEPTING:
            if (at := self.best.get(state)) is not None:
                offer = (at[0], at[1], "", state)
                best = offer if self._better(offer, best) else best
        return best[0], self.rest(best[3])
