"""Suffix sorting by induction over disk-backed queues, with common-prefix values.

The order of all suffixes follows from that of the few that start at a left-most rising place (LMS): suffixes are taken
from the queue of each first symbol in turn, and each puts the one before it at the end of the queue of its own first
symbol; once upwards for falling places, once downwards for rising ones. A queue holds tuples (place, common prefix with
its predecessor); queues over the memory budget go to files. The same induction sorts the LMS substrings; where some are
equal, their names form a shorter text that is sorted by recursion, or directly once it fits in memory.

Prefixes count up to ``cap`` symbols only: order and common prefixes are exact to that depth, ties beyond it are free.
"""

from __future__ import annotations

import os
import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 20
Block = tuple[np.ndarray, np.ndarray]


class Queues:
    """First-in first-out queues of (place, prefix) blocks by symbol; the largest go to disk over the budget."""

    def __init__(self, folder: str, name: str, budget: int):
        self.path, self.budget, self.held = os.path.join(folder, name), budget, 0
        self.blocks: dict[int, list] = defaultdict(list)
        self.sizes: dict[int, int] = defaultdict(int)
        self.taken: dict[int, int] = defaultdict(int)
        self.file = None
        self.spilled = 0

    def put(self, symbol: int, places: np.ndarray, prefixes: np.ndarray) -> None:
        size = places.nbytes + prefixes.nbytes
        self.blocks[symbol].append((places, prefixes))
        self.sizes[symbol] += size
        self.held += size
        while self.held > self.budget:
            self._spill(max(self.sizes, key=self.sizes.get))

    def _spill(self, symbol: int) -> None:
        if self.file is None:
            self.file = open(self.path, "w+b")  # noqa: SIM115 - lives as long as the folder
        self.file.seek(0, os.SEEK_END)
        blocks = self.blocks[symbol]
        for k in range(self.taken[symbol], len(blocks)):
            if len(blocks[k]) == 2:
                places, prefixes = blocks[k]
                blocks[k] = (self.file.tell(), len(places), places.dtype)
                self.file.write(places.tobytes())
                self.file.write(prefixes.tobytes())
        self.held -= self.sizes.pop(symbol)
        self.spilled += 1

    def _read(self, block) -> Block:
        if len(block) == 2:
            return block
        at, n, dtype = block
        self.file.seek(at)
        data = self.file.read(n * (dtype.itemsize + 1))
        return np.frombuffer(data, dtype=dtype, count=n), np.frombuffer(data, dtype=np.uint8, offset=n * dtype.itemsize)

    def take(self, symbol: int) -> Iterator[Block]:
        """Blocks of a queue in turn, put together up to a size, with those that are put in meanwhile."""
        while self.taken[symbol] < len(self.blocks[symbol]):
            got: list[Block] = []
            while self.taken[symbol] < len(self.blocks[symbol]) and sum(len(p) for p, _ in got) < BLOCK:
                k = self.taken[symbol]
                block = self.blocks[symbol][k]
                got.append(self._read(block))
                if len(block) == 2:
                    size = block[0].nbytes + block[1].nbytes
                    self.held -= size
                    self.sizes[symbol] -= size
                self.blocks[symbol][k] = None
                self.taken[symbol] += 1
            yield got[0] if len(got) == 1 else tuple(np.concatenate(x) for x in zip(*got))

    def all(self, symbol: int, reverse: bool = False) -> Iterator[Block]:
        """Blocks of a queue, which stays; each is reversed too if reverse."""
        for block in reversed(self.blocks[symbol]) if reverse else self.blocks[symbol]:
            places, prefixes = self._read(block)
            yield (places[::-1], prefixes[::-1]) if reverse else (places, prefixes)


def rising(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last symbol, the only smallest, counts as rising."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int64) - text[:-1])
    where = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(where[::-1])[::-1]
    return np.concatenate([np.where(following < n, step[np.minimum(following, n - 2)] > 0, True), [True]]) if n > 1 else np.ones(1, dtype=bool)


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix, up to cap, of the suffixes at a and b."""
    out = np.full(len(a), 0, dtype=np.uint8)
    active = np.arange(len(a))
    last = len(text) - 1
    for k in range(cap):
        x, y = a[active] + k, b[active] + k
        same = (x <= last) & (y <= last)
        same[same] = text[x[same]] == text[y[same]]
        active = active[same]
        if not len(active):
            break
        out[active] = k + 1
    return out


class _Induction:
    """One pass over the buckets in a direction; carries, for each symbol, the least prefix since its last entry."""

    def __init__(self, text: np.ndarray, up: np.ndarray, queues: Queues, cap: int, into_rising: bool, with_prefixes: bool):
        self.text, self.up, self.queues, self.cap = text, up, queues, cap
        self.into_rising, self.with_prefixes = into_rising, with_prefixes
        self.since: dict[int, int] = {}
        self.begun: set[int] = set()
        self.last = -1

    def bucket(self) -> None:
        """A new first symbol: nothing in common with what came before."""
        self.since, self.last = {}, -1

    def feed(self, places: np.ndarray, prefixes: np.ndarray, met: bool = True) -> np.ndarray:
        """Put the suffixes before these into their queues. met: prefixes[0] refers to the place fed last."""
        if self.with_prefixes and not met and self.last >= 0:
            prefixes = prefixes.copy()
            prefixes[0] = common(self.text, np.array([self.last]), places[:1], self.cap)[0]
        self.last = int(places[-1])
        before = places - 1
        chosen = np.flatnonzero(before >= 0)
        chosen = chosen[self.up[before[chosen]] == self.into_rising]
        symbols = self.text[before[chosen]]
        order = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[order]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(sorted_symbols)) + 1, [len(order)]]) if len(order) else [0]
        touched = set()
        for a, b in zip(edges[:-1], edges[1:]):
            symbol, source = int(sorted_symbols[a]), chosen[order[a:b]]
            out = np.zeros(b - a, dtype=np.uint8)
            if self.with_prefixes:
                touched.add(symbol)
                least = np.minimum.reduceat(prefixes, np.concatenate([[0], source[:-1] + 1]))
                out[1:] = np.minimum(least[1:] + 1 if b - a > 1 else 0, self.cap)
                head = int(prefixes[:source[0] + 1].min())
                if symbol in self.since:
                    out[0] = min(self.since[symbol], head, self.cap - 1) + 1
                elif symbol in self.begun:
                    out[0] = 1
                if b - a > 1:
                    # The last segment of reduceat runs to the end; cut it at its source.
                    out[-1] = min(int(prefixes[source[-2] + 1:source[-1] + 1].min()), self.cap - 1) + 1
                self.since[symbol] = int(prefixes[source[-1] + 1:].min(initial=self.cap))
                self.begun.add(symbol)
            self.queues.put(symbol, before[source], out)
        if self.with_prefixes:
            least = int(prefixes.min())
            for symbol in self.since.keys() - touched:
                self.since[symbol] = min(self.since[symbol], least)
        return prefixes


def induce(text: np.ndarray, up: np.ndarray, seeds: np.ndarray, prefixes: np.ndarray, folder: str, budget: int, cap: int,
           with_prefixes: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(symbol, places, prefixes) of all suffixes' buckets, from the largest symbol to the smallest, each in ascending order.

    seeds are the LMS places, sorted (by their first symbol at least), prefixes those in common with the seed before.
    """
    name = f"{len(os.listdir(folder))}-{{}}"
    falling, rises = Queues(folder, name.format("l"), budget), Queues(folder, name.format("s"), budget)
    done = Queues(folder, name.format("d"), budget)
    first = text[seeds]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(first)) + 1, [len(seeds)]])
    span = {int(first[a]): (a, b) for a, b in zip(edges[:-1], edges[1:])}
    symbols = np.unique(text).tolist()
    walk = _Induction(text, up, falling, cap, False, with_prefixes)
    for c in symbols:
        walk.bucket()
        for places, shared in falling.take(c):
            done.put(c, places, walk.feed(places, shared))
        if c in span:
            a, b = span[c]
            walk.feed(seeds[a:b], prefixes[a:b], met=False)
    walk = _Induction(text, up, rises, cap, True, with_prefixes)
    rises.put(int(text[-1]), np.array([len(text) - 1], dtype=seeds.dtype), np.zeros(1, dtype=np.uint8))
    for c in reversed(symbols):
        walk.bucket()
        upper: list[Block] = []
        for places, shared in rises.take(c):
            upper.append((places, walk.feed(places, shared)))
        following = np.zeros(1, dtype=np.uint8)
        lower: list[Block] = []
        for k, (places, shared) in enumerate(done.all(c, reverse=True)):
            # Downwards, a place's prefix is the one its upper neighbour had upwards.
            walk.feed(places, np.concatenate([following, shared[:-1]]), met=k > 0)
            following = shared[-1:]
            lower.append((places[::-1], shared[::-1]))
        places = np.concatenate([p for p, _ in lower[::-1]] + [p[::-1] for p, _ in upper[::-1]])
        down = np.concatenate([s for _, s in upper]) if upper else np.zeros(0, dtype=np.uint8)
        shared = np.concatenate([s for _, s in lower[::-1]] + [np.zeros(1 if upper else 0, dtype=np.uint8), down[1:][::-1]])
        n = len(places) - len(down)
        if with_prefixes and upper and n:
            shared[n] = common(text, places[n - 1:n], places[n:n + 1], cap)[0]
        yield c, places, shared


def _directly(names: np.ndarray, cap: int) -> np.ndarray:
    """Order of the suffixes of a text that fits in memory, by doubling."""
    rank, width, n = names.astype(np.int64), 1, len(names)
    while True:
        following = np.zeros(n, dtype=np.int64)
        following[:n - width if width < n else 0] = rank[width:] + 1
        key = rank * (n + 2) + following
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, dtype=np.int64)
        new[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        width *= 2
        if new.max() == n - 1 or width >= min(n, max(cap, 1)):
            return order
        rank = new


def suffixes(text: np.ndarray, cap: int, folder: str, *, budget: int = 256 << 20, leaf: int = 1 << 24) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Buckets (symbol, places, prefixes) of all suffixes of text, symbols descending, each bucket in ascending order.

    text is of non-negative integers and ends in a 0 that is nowhere else. budget: bytes a set of queues keeps in memory;
    leaf: length to which a shorter text is sorted directly.
    """
    kind = np.int32 if len(text) < 2**31 else np.int64
    up = rising(text)
    lms = (np.flatnonzero(up[1:] & ~up[:-1]) + 1).astype(kind)
    if not len(lms):  # a text that only rises or is its end alone
        lms = np.array([len(text) - 1], dtype=kind)
    seeds = lms[np.argsort(text[lms], kind="stable")]
    is_lms = np.zeros(len(text), dtype=bool)
    is_lms[lms] = True
    ordered = [p[is_lms[p]] for _, p, _ in induce(text, up, seeds, np.zeros(len(seeds), dtype=np.uint8), folder, budget, cap, with_prefixes=False)]
    order = np.concatenate(ordered[::-1])
    # Name the substrings between LMS places: equal ones share a name.
    number = np.zeros(len(text), dtype=kind)
    number[lms] = np.arange(len(lms))
    ends = np.concatenate([lms[1:], [len(text) - 1]])
    lengths = (ends - lms + 1)[number[order]]
    same = np.zeros(len(order), dtype=bool)
    left = np.flatnonzero(lengths[1:] == lengths[:-1]) + 1
    k = 0
    while len(left):
        a, b = order[left - 1] + k, order[left] + k
        left = left[(text[a] == text[b]) & (up[a] == up[b])]
        k += 1
        over = lengths[left] <= k
        same[left[over]] = True
        left = left[~over]
    names = np.zeros(len(lms), dtype=np.int64)
    names[number[order]] = np.cumsum(~same) - 1
    if same.any():
        if len(names) <= leaf:
            order = lms[_directly(names, cap)]
        else:
            shorter = np.concatenate([names + 1, [0]])
            found = [p for _, p, _ in suffixes(shorter, min(cap, 255), folder, budget=budget, leaf=leaf)]
            ranks = np.concatenate(found[::-1])
            order = lms[ranks[ranks < len(lms)]]
    shared = np.zeros(len(order), dtype=np.uint8)
    shared[1:] = common(text, order[:-1], order[1:], cap)
    yield from induce(text, up, order, shared, folder, budget, cap)


def scratch(prefix: str = "suffixes-") -> tempfile.TemporaryDirectory:
    """A task's own folder for its queues; it goes with the task, and another attempt makes its own."""
    return tempfile.TemporaryDirectory(prefix=prefix)
