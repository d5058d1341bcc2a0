"""A finger B-tree of partial aggregates keyed by event time.

Leaves hold the partial aggregate of each period, every node the aggregate of its subtree.  A finger on the last leaf
makes inserts near the end of time cheap; a late insert climbs from there only as far as it is late, and updates the
partials of its ancestors, a logarithmic number.  The tree knows the mark of event time: a cut-off behind it drops whole
subtrees, and what is offered to the tree is answered with the state of its period.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

#: count, sum, least, greatest; the last three are None while no value was seen.
Partial = tuple[int, float | None, float | None, float | None]
NONE: Partial = (0, None, None, None)
WIDTH = 8
#: States of a period: at or after the mark; before it, yet to be corrected; before the cut-off.
NEWEST, OPEN, CLOSED = "newest", "open", "closed"


def combined(a: Partial, b: Partial) -> Partial:
    if a[1] is None or b[1] is None:
        return (a[0] + b[0], *(b[1:] if a[1] is None else a[1:]))
    return (a[0] + b[0], a[1] + b[1], min(a[2], b[2]), max(a[3], b[3]))


class _Node:
    __slots__ = ("times", "parts", "kids", "total", "parent")

    def __init__(self, times: list, parts: list | None = None, kids: list | None = None):
        self.times = times  # of a leaf: its periods; of an inner node: each kid's first period
        self.parts = parts
        self.kids = kids
        self.parent: _Node | None = None
        for k in kids or ():
            k.parent = self
        self.sum_up()

    def sum_up(self) -> None:
        total = NONE
        for x in self.parts if self.kids is None else (k.total for k in self.kids):
            total = combined(total, x)
        self.total = total


class FingerTree:
    """``keep`` keeps the last aggregate of the periods that were dropped, to answer late offers with it."""

    def __init__(self, keep: bool = True) -> None:
        self.root = _Node([], [])
        self.finger = self.root  # the last leaf
        self.mark = self.cut = None
        self.closed: dict | None = {} if keep else None

    def advance(self, mark, lateness) -> list[tuple[object, Partial]]:
        """Moves the mark forward, and the cut-off to ``lateness`` behind it; the periods that this closes, in order."""
        if mark is None or self.mark is not None and mark <= self.mark:
            return []
        self.mark, self.cut = mark, mark - lateness
        gone = list(self.evict(self.cut))
        if self.closed is not None:
            self.closed.update(gone)
        return gone

    def offer(self, time, part: Partial) -> tuple[str, Partial, Partial]:
        """(state of the period, its aggregate before, after): a closed period takes nothing."""
        if self.cut is not None and time < self.cut:
            last = (self.closed or {}).get(time, NONE)
            return CLOSED, last, last
        return OPEN if self.mark is not None and time < self.mark else NEWEST, *self.insert(time, part)

    def insert(self, time, part: Partial) -> tuple[Partial, Partial]:
        """Adds a partial to a period; its aggregate before and after."""
        node = self.finger
        while node.parent is not None and (not node.times or time < node.times[0]):
            node = node.parent
        while node.kids is not None:
            i = max(0, bisect_right(node.times, time) - 1)
            node.times[i] = min(node.times[i], time)
            node = node.kids[i]
        up = node.parent
        while up is not None and time < up.times[0]:  # a new first period on the left spine
            up.times[0] = time
            up = up.parent
        i = bisect_left(node.times, time)
        if i < len(node.times) and node.times[i] == time:
            before = node.parts[i]
            node.parts[i] = combined(before, part)
        else:
            before = NONE
            node.times.insert(i, time)
            node.parts.insert(i, part)
        after = node.parts[i]
        up = node
        while up is not None:
            up.total = combined(up.total, part)
            up = up.parent
        if len(node.times) > WIDTH:
            self._split(node)
        return before, after

    def _split(self, node: _Node) -> None:
        while len(node.times) > WIDTH:
            half = len(node.times) // 2
            if node.kids is None:
                right = _Node(node.times[half:], node.parts[half:])
                del node.parts[half:]
                if node is self.finger:
                    self.finger = right
            else:
                right = _Node(node.times[half:], None, node.kids[half:])
                del node.kids[half:]
            del node.times[half:]
            node.sum_up()
            parent = node.parent
            if parent is None:
                self.root = _Node([node.times[0], right.times[0]], None, [node, right])
                return
            i = parent.kids.index(node) + 1
            parent.kids.insert(i, right)
            parent.times.insert(i, right.times[0])
            right.parent = parent
            node = parent

    def evict(self, before) -> Iterator[tuple[object, Partial]]:
        """Drops all periods earlier than ``before``, whole subtrees at a time; they come out in order."""
        gone: list[_Node | tuple] = []
        node, spine = self.root, []
        while True:
            spine.append(node)
            if node.kids is None:
                i = bisect_left(node.times, before)
                gone += zip(node.times[:i], node.parts[:i], strict=True)
                del node.times[:i], node.parts[:i]
                break
            i = max(0, bisect_left(node.times, before) - 1)  # kids left of i lie before the cut-off altogether
            gone += node.kids[:i]
            del node.kids[:i], node.times[:i]
            node = node.kids[0]
        for node in reversed(spine):
            if node.kids is not None:
                if not node.kids[0].times:
                    del node.kids[0], node.times[0]
                elif node.kids:
                    node.times[0] = node.kids[0].times[0]
            node.sum_up()
        while self.root.kids is not None and len(self.root.kids) <= 1:
            self.root = self.root.kids[0] if self.root.kids else _Node([], [])
            self.root.parent = None
        self.finger = self.root
        while self.finger.kids is not None:
            self.finger = self.finger.kids[-1]
        for x in gone:
            if isinstance(x, _Node):
                yield from self._periods(x)
            else:
                yield x

    def _periods(self, node: _Node) -> Iterator[tuple[object, Partial]]:
        if node.kids is None:
            yield from zip(node.times, node.parts, strict=True)
        else:
            for k in node.kids:
                yield from self._periods(k)

    def periods(self) -> list[tuple[object, Partial]]:
        return list(self._periods(self.root))

    def total(self, first=None, last=None) -> Partial:
        """The aggregate of all periods from ``first`` to ``last``, both included."""
        return self._between(self.root, first, last)

    def _between(self, node: _Node, first, last) -> Partial:
        if first is None and last is None:
            return node.total
        out = NONE
        if node.kids is None:
            for t, p in zip(node.times, node.parts, strict=True):
                if (first is None or t >= first) and (last is None or t <= last):
                    out = combined(out, p)
            return out
        for i, kid in enumerate(node.kids):
            end = node.times[i + 1] if i + 1 < len(node.kids) else None
            if (last is not None and node.times[i] > last) or (first is not None and end is not None and end <= first):
                continue
            inner_first = None if first is None or node.times[i] >= first else first
            inner_last = None if last is None or (end is not None and end <= last) else last
            out = combined(out, self._between(kid, inner_first, inner_last))
        return out
