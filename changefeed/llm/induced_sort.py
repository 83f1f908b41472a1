"""External suffix sorting by recursive induction.

Suffixes are sorted from those that start at a local minimum ("starred"). Their
substrings are ordered by one induction and named, the text of names is sorted by
recursion, and a second induction derives the order of all suffixes: each suffix
taken from the queue puts the one before it back, under that one's first symbol.

The queue hands out symbols in order and, for one symbol, suffixes in the order
they came, which is their order. Its entries are suffix tuples with the length of
the prefix shared with the entry before. An induced entry shares one symbol more
than the least that lies between its source and the source of the entry before
it, so common prefixes are carried along and never compared again, up to ``CAP``.

Queues keep at most ``HELD`` bytes and write older blocks to a temporary file of
the task, which ends with it. Blocks are worked on as arrays of bounded size. A text
of many symbols for its length, as that of names, is sorted by doubling instead.
"""

from __future__ import annotations

import heapq
import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np

CAP = 200
HELD = 64 * 1024 * 1024
BLOCK = 1 << 17

# Entries a symbol must have on average for blocks to pay.
FEW_EACH = 200


class DiskQueue:
    """Blocks of (position, shared prefix) by symbol; first in, first out for one symbol."""

    def __init__(self, largest_first: bool):
        self.sign = -1 if largest_first else 1
        self.blocks: dict[int, deque] = {}
        self.heap: list[int] = []
        self.held = 0
        self.file = None

    def put(self, symbol: int, places: np.ndarray, shared: np.ndarray) -> None:
        known = self.blocks.get(symbol)
        if known is None:
            known = self.blocks[symbol] = deque()
            heapq.heappush(self.heap, self.sign * symbol)
        known.append((places, shared))
        self.held += places.nbytes + shared.nbytes
        if self.held > HELD:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for blocks in self.blocks.values():
            for i, block in enumerate(blocks):
                if isinstance(block[0], np.ndarray):
                    at = self.file.tell()
                    self.file.write(block[0].tobytes())
                    self.file.write(block[1].tobytes())
                    blocks[i] = (at, len(block[0]))
        self.held = 0

    def first(self) -> int | None:
        """The next symbol."""
        return self.sign * self.heap[0] if self.heap else None

    def take(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All blocks of a symbol, also those that are put while it is being worked on."""
        while blocks := self.blocks.get(symbol):
            taken, size = [], 0
            while blocks and size < BLOCK:
                block = blocks.popleft()
                if not isinstance(block[0], np.ndarray):
                    at, n = block
                    self.file.seek(at)
                    block = (
                        np.frombuffer(self.file.read(4 * n), np.int32), np.frombuffer(self.file.read(2 * n), np.int16)
                    )
                else:
                    self.held -= block[0].nbytes + block[1].nbytes
                taken.append(block)
                size += len(block[0])
            yield tuple(map(np.concatenate, zip(*taken))) if len(taken) > 1 else taken[0]
        if symbol in self.blocks:
            # a symbol is only taken when it is the next one
            del self.blocks[symbol]
            heapq.heappop(self.heap)


class Ranges:
    """Least values over ranges of one array."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << len(self.rows) - 1 <= len(values):
            last, step = self.rows[-1], 1 << len(self.rows) - 1
            self.rows.append(np.minimum(last[:-step], last[step:]))

    def least(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Least of [start, stop) for each pair; ranges are not empty."""
        level = np.frexp(stop - start)[1] - 1
        out = np.empty(len(start), self.rows[0].dtype)
        for k in np.unique(level):
            at = level == k
            row = self.rows[k]
            out[at] = np.minimum(row[start[at]], row[stop[at] - (1 << int(k))])
        return out


class Inducer:
    """One direction of induction over a text."""

    def __init__(self, text: np.ndarray, largest_first: bool, with_shared: bool):
        self.text, self.down, self.with_shared = text, largest_first, with_shared
        self.queue = DiskQueue(largest_first)
        # least shared prefix of all sources since a symbol last got an entry
        self.since: dict[int, int] = {}
        self.gap: np.ndarray | None = np.full(int(text.max()) + 1, CAP, np.int16) if with_shared else None

    def induce(self, places: np.ndarray, shared: np.ndarray, keep: np.ndarray) -> None:
        """Put the suffixes before ``places`` where ``keep`` holds."""
        at = np.flatnonzero(keep)
        if len(at):
            before = places[at] - 1
            symbols = self.text[before]
            order = np.argsort(symbols, kind="stable")
            at, before, symbols = at[order], before[order], symbols[order]
            first = np.concatenate(([True], symbols[1:] != symbols[:-1]))
            begins = np.flatnonzero(first)
            if self.with_shared:
                ranges = Ranges(shared)
                new = np.empty(len(at), np.int16)
                rest = np.flatnonzero(~first)
                if len(rest):
                    new[rest] = ranges.least(at[rest - 1] + 1, at[rest] + 1)
                own = symbols[begins]
                head = ranges.least(np.zeros(len(begins), np.int64), at[begins] + 1)
                known = np.fromiter((int(c) in self.since for c in own), bool, len(own))
                new[begins] = np.where(known, np.minimum(self.gap[own], head), -1)
                new = np.minimum(new + 1, CAP).astype(np.int16)
            else:
                new = np.zeros(len(at), np.int16)
            ends = np.concatenate((begins[1:], [len(at)]))
            for b, e in zip(begins.tolist(), ends.tolist()):
                symbol = int(symbols[b])
                self.since[symbol] = 1
                for k in range(b, e, BLOCK):
                    self.queue.put(symbol, before[k : min(e, k + BLOCK)].astype(np.int32), new[k : min(e, k + BLOCK)])
            if self.with_shared:
                np.minimum(self.gap, shared.min(), out=self.gap)
                last = at[ends - 1] + 1
                tail = np.full(len(last), CAP, np.int16)
                some = last < len(shared)
                tail[some] = ranges.least(last[some], np.full(int(some.sum()), len(shared)))
                self.gap[symbols[begins]] = tail
        elif self.with_shared and len(shared):
            np.minimum(self.gap, shared.min(), out=self.gap)


def types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the one after it; the end is smallest of all."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int64), append=-1))
    far = np.where(step != 0, np.arange(n), n - 1)
    far = np.minimum.accumulate(far[::-1])[::-1]
    return step[far] > 0


def packed(text: np.ndarray) -> tuple[np.ndarray, int]:
    """A word of the next symbols for each place, in their order, and how many it holds; nothing is smallest, after the end."""
    bits = (int(text.max()) + 1).bit_length()
    each = max(1, 62 // bits)
    padded = np.zeros(len(text) + each, np.int64)
    padded[: len(text)] = text
    padded[: len(text)] += 1
    words = np.zeros(len(text), np.int64)
    for k in range(each):
        words <<= bits
        words |= padded[k : k + len(text)]
    return words, each


def common(text: np.ndarray, words: np.ndarray, each: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of suffixes, up to CAP; ``words`` and ``each`` are the packed text."""
    n, out = len(text), np.zeros(len(a), np.int16)
    live, k = np.arange(len(a)), 0
    while len(live) and k < CAP:
        i, j = a[live] + k, b[live] + k
        inside = (i < n) & (j < n)
        live, i, j = live[inside], i[inside], j[inside]
        same = words[i] == words[j]
        # the word that differs holds the end of the prefix
        ended, i, j = live[~same], i[~same], j[~same]
        for step in range(each):
            inside = (i < n) & (j < n)
            ended, i, j = ended[inside], i[inside], j[inside]
            equal = text[i] == text[j]
            ended, i, j = ended[equal], i[equal] + 1, j[equal] + 1
            out[ended] = min(k + step + 1, CAP)
        live, k = live[same], k + each
        out[live] = min(k, CAP)
    return out


def _by_symbol(text: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[int, int]]]:
    """Places grouped by first symbol, each group in the given order."""
    symbols = text[places]
    order = np.argsort(symbols, kind="stable")
    places, symbols = places[order], symbols[order]
    edges = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1], [True]))) if len(places) else np.zeros(1, int)
    return places, {int(symbols[b]): (b, e) for b, e in zip(edges[:-1].tolist(), edges[1:].tolist())}


def induced(text: np.ndarray, small: np.ndarray, starred: np.ndarray, with_shared: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (places, shared prefixes) of all suffixes, from the largest down.

    ``starred`` holds the starred suffixes in order. The first value of a block
    is the prefix shared with the last entry of the block before it.
    """
    n = len(text)
    starred, groups = _by_symbol(text, starred)
    star_shared = np.zeros(len(starred), np.int16)
    words, each = packed(text) if with_shared else (None, 0)
    if with_shared and len(starred) > 1:
        star_shared[1:] = common(text, words, each, starred[:-1], starred[1:])
    up = Inducer(text, False, with_shared)
    if not small[n - 1]:
        up.since[int(text[n - 1])] = 1
        up.queue.put(int(text[n - 1]), np.array([n - 1], np.int32), np.zeros(1, np.int16))
        if with_shared:
            up.gap[:] = 0
    larges = DiskQueue(True)  # what the first pass found, kept by symbol for the second
    pending = sorted(groups, reverse=True)
    while True:
        symbol = up.queue.first()
        if pending and (symbol is None or pending[-1] < symbol):
            symbol = pending[-1]
        if symbol is None:
            break
        last = None
        for places, shared in up.queue.take(symbol):
            larges.put(symbol, places, shared)
            ok = places > 0
            ok[ok] = text[places[ok] - 1] >= symbol
            up.induce(places, shared, ok & ~small[places - 1])
            last = places[-1]
        if pending and pending[-1] == symbol:
            pending.pop()
            b, e = groups[symbol]
            for k in range(b, e, BLOCK):
                places, shared = starred[k : min(e, k + BLOCK)].astype(np.int32), star_shared[k : min(e, k + BLOCK)].copy()
                if with_shared and k == b:
                    shared[0] = common(text, words, each, np.array([last]), places[:1].astype(np.int64))[0] if last is not None else 0
                up.induce(places, shared, places > 0)
    down = Inducer(text, True, with_shared)
    while True:
        symbol = down.queue.first()
        other = larges.first()
        if symbol is None or (other is not None and other > symbol):
            symbol = other
        if symbol is None:
            break
        last = None
        for places, shared in down.queue.take(symbol):
            yield places, shared
            ok = places > 0
            ok[ok] = text[places[ok] - 1] <= symbol
            down.induce(places, shared, ok & small[places - 1])
            last = places[-1]
        # the first pass met these from the smallest up; shared prefixes move to the other neighbour
        blocks = list(larges.take(symbol))
        after = None
        for places, shared in reversed(blocks):
            turned = np.empty_like(shared)
            turned[1:] = shared[::-1][:-1]
            if after is not None:
                turned[0] = after
            else:
                turned[0] = common(text, words, each, np.array([last]), places[-1:].astype(np.int64))[0] if with_shared and last is not None else 0
            after = shared[0]
            places = places[::-1]
            yield places, turned
            ok = places > 0
            ok[ok] = text[places[ok] - 1] <= symbol
            down.induce(places, turned, ok & small[places - 1])


def by_doubling(text: np.ndarray) -> np.ndarray:
    """All suffixes of a text in order, for texts whose symbols are too many for blocks to pay.

    Suffixes are ranked by one word each, then by the ranks of what follows, twice as far in each round; only those of
    equal rank are sorted again.
    """
    n = len(text)
    words, reach = packed(text)
    found = np.argsort(words)
    rank, slots, key = np.empty(n, np.int64), np.arange(n), words[found]
    while True:
        some = found[slots]
        heads = np.concatenate(([True], key[1:] != key[:-1]))
        rank[some] = slots[heads][np.cumsum(heads) - 1]
        open_ = ~(heads & np.append(heads[1:], True))
        slots, some = slots[open_], some[open_]
        if not len(slots):
            return found.astype(np.int32)
        key = rank[some] * (n + 1)
        after = some + reach
        inside = after < n
        key[inside] += rank[after[inside]] + 1
        by_key = np.argsort(key)
        found[slots], key = some[by_key], key[by_key]
        reach *= 2


def _many(text: np.ndarray) -> bool:
    return len(text) < FEW_EACH * (int(text.max()) + 1)


def order(text: np.ndarray) -> np.ndarray:
    """All suffixes of a text in order."""
    if not len(text):
        return np.empty(0, np.int32)
    if _many(text):
        return by_doubling(text)
    small = types(text)
    parts = [places for places, _ in induced(text, small, sorted_stars(text, small), False)]
    return np.concatenate(parts)[::-1]


def sorted_stars(text: np.ndarray, small: np.ndarray) -> np.ndarray:
    """The starred suffixes in order: substrings first, then by recursion over their names."""
    n = len(text)
    is_star = np.zeros(n, bool)
    is_star[1:] = small[1:] & ~small[:-1]
    stars = np.flatnonzero(is_star)
    if len(stars) < 2:
        return stars
    if _many(text):
        every = by_doubling(text)
        return every[is_star[every]].astype(np.int64)
    found = [places[is_star[places]] for places, _ in induced(text, small, stars, False)]
    ranked = np.concatenate(found)[::-1].astype(np.int64)
    number = np.zeros(n, np.int32)
    number[stars] = np.arange(len(stars))
    ends = np.append(stars[1:] + 1, n)
    size = (ends - stars)[number[ranked]]
    final = number[ranked] == len(stars) - 1
    a, b = ranked[:-1], ranked[1:]
    equal = (size[:-1] == size[1:]) & ~final[:-1] & ~final[1:]
    live, k = np.flatnonzero(equal), 0
    while len(live):
        live = live[k < size[live]]
        differ = text[a[live] + k] != text[b[live] + k]
        equal[live[differ]] = False
        live, k = live[~differ], k + 1
    names = np.concatenate(([0], np.cumsum(~equal)))
    if names[-1] + 1 == len(stars):
        return ranked
    reduced = np.empty(len(stars), np.int64)
    reduced[number[ranked]] = names
    return stars[order(reduced)]


def repeated_starts(text: np.ndarray, length: int = CAP) -> np.ndarray:
    """True at positions whose next ``length`` symbols also start elsewhere; ``length`` is at most CAP."""
    out = np.zeros(len(text), bool)
    if not len(text):
        return out
    small, last = types(text), None
    for places, shared in induced(text, small, sorted_stars(text, small), True):
        hit = shared >= length
        out[places[hit]] = True
        if hit[0] and last is not None:
            out[last] = True
        out[places[:-1][hit[1:]]] = True
        last = places[-1]
    return out
