"""Suffixes in order, with their common prefixes, by external induced sorting.

Suffixes are L (larger than their successor) or S. Once the leftmost-S suffixes are in order, every other suffix follows from its
successor's: going through the suffixes from the least on, each puts the one before it, if L, into a priority queue by its first symbol, where
equal symbols keep the order in which they came; going down from the greatest, the same with S. The queues carry tuples (symbol, position,
common prefix): the common prefix of two neighbours of a queue is one more than the least one that has been passed between their successors,
so a running minimum for each symbol is all that is kept of the past. The leftmost-S substrings are sorted by the same induction, named, and
the string of names, at most half as long, is sorted by recursion; one that fits into memory by prefix doubling.

Nothing that grows with the text stays in the heap beyond ``memory``: text, types, positions and names are arrays on disk, queues spill sorted runs
to disk and read them back in pieces, and the result is handed out in pieces. Scratch is removed with the call.

Common prefixes are told up to ``limit`` symbols, which is all that a search for repeats of that length needs.
"""

from __future__ import annotations

import heapq
import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np

MEMORY = 512 << 20
#: Runs of a queue that are read side by side; more are merged.
MAX_RUNS = 64
_FAR = np.int64(1) << 60


class Scratch:
    """Files of one call, and arrays that are in memory as long as they are small."""

    def __init__(self, memory: int):
        self.memory, self.folder, self.n = memory, None, 0
        #: Items that are worked on at a time; about thirty words of eight bytes each are held for one.
        self.block = max(128, memory // 512)

    def path(self) -> str:
        if self.folder is None:
            self.folder = tempfile.mkdtemp(prefix="induced-")
        self.n += 1
        return os.path.join(self.folder, f"{self.n}.bin")

    def array(self, n: int, dtype) -> np.ndarray:
        if n * np.dtype(dtype).itemsize <= self.memory // 32:
            return np.zeros(n, dtype)
        return np.memmap(self.path(), dtype, "w+", shape=(n,))

    def blocks(self, n: int) -> Iterator[tuple[int, int]]:
        return ((a, min(n, a + self.block)) for a in range(0, n, self.block))

    def __enter__(self):
        return self

    def __exit__(self, *_):
        if self.folder:
            shutil.rmtree(self.folder, ignore_errors=True)


class Queue:
    """Priority queue of (key, position, value): the least key first, equal keys in the order in which they came."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.file, self.path, self.size = scratch, None, None, 0
        self.held: dict[int, list[np.ndarray]] = {}
        self.keys: list[int] = []  # heap of the keys in ``held``
        self.runs: list[list] = []  # [offset, end, piece that was read and not yet taken]
        self.heads: list[tuple[int, int]] = []  # heap of (least key, run)

    def push(self, keys: np.ndarray, pos: np.ndarray, value: np.ndarray) -> None:
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        rows = np.stack([keys[order], pos[order], value[order]], axis=1)
        cut = (np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1).tolist()
        for a, b in zip([0, *cut], [*cut, len(rows)], strict=True):
            key = int(rows[a, 0])
            if key not in self.held:
                self.held[key] = []
                heapq.heappush(self.keys, key)
            self.held[key].append(rows[a:b].copy() if b - a < len(rows) else rows)
            self.size += (b - a) * 24 + 200
        if self.size > self.scratch.memory // 4:
            self._spill()

    def _spill(self) -> None:
        """What is in memory becomes a sorted run behind the others."""
        if self.file is None:
            self.path = self.scratch.path()
            self.file = open(self.path, "w+b", buffering=0)  # noqa: SIM115  closed by close()
        begin = self.file.seek(0, os.SEEK_END)
        for key in sorted(self.held):
            for rows in self.held[key]:
                self.file.write(np.ascontiguousarray(rows).tobytes())
        self.held, self.keys, self.size = {}, [], 0
        self.runs.append([begin, self.file.tell(), np.empty((0, 3), np.int64)])
        self._read(len(self.runs) - 1)
        if len(self.runs) > MAX_RUNS:
            self._merge()

    def _read(self, i: int) -> None:
        """The next piece of a run; its least key joins the heads."""
        run = self.runs[i]
        if not len(run[2]) and run[0] < run[1]:
            n = max(1, min((run[1] - run[0]) // 24, self.scratch.memory // (8 * 24 * (len(self.runs) + 8))))
            self.file.seek(run[0])
            run[2] = np.frombuffer(self.file.read(n * 24), np.int64).reshape(-1, 3)
            run[0] += n * 24
        if len(run[2]):
            heapq.heappush(self.heads, (int(run[2][0, 0]), i))

    def _taken(self) -> np.ndarray:
        """The least key's items of the first run that has any, as far as they have been read."""
        key, i = heapq.heappop(self.heads)
        piece = self.runs[i][2]
        n = len(piece) if piece[-1, 0] == key else int(np.searchsorted(piece[:, 0], key, "right"))
        self.runs[i][2] = piece[n:]
        self._read(i)
        return piece[:n]

    def _merge(self) -> None:
        """All runs become one, in a new file."""
        path, size = self.scratch.path(), 0
        with open(path, "wb", buffering=max(4096, self.scratch.memory // 16)) as out:
            while self.heads:
                size += out.write(np.ascontiguousarray(self._taken()).tobytes())
        self.close()
        os.remove(self.path)
        self.path = path
        self.file = open(path, "r+b", buffering=0)  # noqa: SIM115  closed by close()
        self.runs = [[0, size, np.empty((0, 3), np.int64)]]
        self._read(0)

    def peek(self) -> int | None:
        if self.heads and (not self.keys or self.heads[0][0] <= self.keys[0]):
            return self.heads[0][0]
        return self.keys[0] if self.keys else None

    def pop(self) -> tuple[np.ndarray, np.ndarray]:
        """(positions, values) of the next items of the least key, as many as are at hand up to a block."""
        key, parts, n = self.peek(), [], 0
        # runs were written one after the other: the first has what came first
        while self.heads and self.heads[0][0] == key and n < self.scratch.block:
            parts.append(self._taken())
            n += len(parts[-1])
        if not parts:
            heapq.heappop(self.keys)
            parts = self.held.pop(key)
            self.size -= sum(map(len, parts)) * 24 + 200 * len(parts)
        rows = parts[0] if len(parts) == 1 else np.concatenate(parts)
        return rows[:, 1], rows[:, 2]

    def close(self) -> None:
        if self.file:
            self.file.close()


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Length, up to ``limit``, of the common prefix of the suffixes at a[i] and b[i], of which none is a prefix of the other."""
    out, alive = np.zeros(len(a), np.int64), np.arange(len(a))
    k = 0
    while len(alive) and k < limit:
        alive = alive[text[a[alive] + k] == text[b[alive] + k]]
        k += 1
        out[alive] = k
    return out


class Passed:
    """For each symbol the least common prefix that has been passed since something was put into its queue."""

    def __init__(self, symbols: int, limit: int):
        self.least, self.limit = np.full(symbols, _FAR), limit

    def values(self, lcp: np.ndarray, at: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Common prefixes of what is put into queues ``symbols`` at places ``at`` of a stretch with common prefixes ``lcp``."""
        order = np.argsort(symbols, kind="stable")
        i, s = at[order], symbols[order]
        first = np.append(True, s[1:] != s[:-1]) if len(s) else np.empty(0, bool)
        out = np.empty(len(s), np.int64)
        out[first] = np.minimum(self.least[s[first]], np.minimum.accumulate(lcp)[i[first]])
        rest = np.flatnonzero(~first)
        if len(rest):
            # the least of lcp[j + 1 .. k] for each place k and the place j before it in the same queue
            bounds = np.stack([i[rest - 1] + 1, i[rest] + 1], axis=1).ravel()
            out[rest] = np.minimum.reduceat(np.append(lcp, _FAR), bounds)[::2]
        np.minimum(self.least, lcp.min(), out=self.least)
        last = np.flatnonzero(np.append(s[1:] != s[:-1], True)) if len(s) else np.empty(0, np.int64)
        behind = np.append(np.minimum.accumulate(lcp[::-1])[::-1], _FAR)
        self.least[s[last]] = behind[i[last] + 1]
        value = np.empty(len(s), np.int64)
        value[order] = np.minimum(out + 1, self.limit)
        return value


def _types(text: np.ndarray, scratch: Scratch) -> np.ndarray:
    """1 where a suffix is S; the text ends with its one least symbol."""
    n = len(text)
    small = scratch.array(n, np.uint8)
    small[n - 1] = 1
    for a, b in reversed(list(scratch.blocks(n - 1))):
        here, after = np.asarray(text[a:b]), np.asarray(text[a + 1 : b + 1])
        # equal neighbours are of one type: that of the next place where symbols differ
        differs = np.where(here != after, np.arange(b - a), b - a)
        at = np.minimum.accumulate(differs[::-1])[::-1]
        small[a:b] = np.append((here < after).astype(np.uint8), small[b])[at]
    return small


class Induction:
    """One text's suffixes, from the leftmost-S ones in order (or in any order, for their substrings alone)."""

    def __init__(self, text: np.ndarray, small: np.ndarray, scratch: Scratch, symbols: int | None, limit: int):
        self.text, self.small, self.scratch, self.symbols, self.limit = text, small, scratch, symbols, limit

    def _send(self, queue: Queue, passed: Passed | None, pos: np.ndarray, lcp: np.ndarray, small: int, sign: int) -> None:
        """Put the predecessors of one type of a stretch of suffixes into the queue."""
        at = np.flatnonzero(pos > 0)
        at = at[self.small[pos[at] - 1] == small]
        before = pos[at] - 1
        symbol = self.text[before].astype(np.int64)
        queue.push(sign * symbol, before, passed.values(lcp, at, symbol) if passed else np.zeros(len(at), np.int64))

    def _passed(self) -> Passed | None:
        return None if self.symbols is None else Passed(self.symbols, self.limit)

    def run(self, seeds: Queue) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, common prefixes with the next greater) of all suffixes but the last, in pieces, the greatest first."""
        text, scratch, passed, queue, size = self.text, self.scratch, self._passed(), Queue(self.scratch), 0
        n = len(text)
        large, large_lcp = scratch.array(n, np.int64), scratch.array(n, np.int32)
        while (key := min((k for k in (queue.peek(), seeds.peek()) if k is not None), default=None)) is not None:
            last = None
            while queue.peek() == key:
                pos, lcp = queue.pop()
                if last is None:
                    lcp = np.append(0, lcp[1:])
                last = pos[-1:]
                large[size : size + len(pos)], large_lcp[size : size + len(pos)] = pos, lcp
                size += len(pos)
                self._send(queue, passed, pos, lcp, 0, 1)
            first = True
            while seeds.peek() == key:
                pos, lcp = seeds.pop()
                if first:
                    lcp = np.append(0 if last is None else common_prefix(text, last, pos[:1], self.limit), lcp[1:])
                first = False
                self._send(queue, passed, pos, lcp, 0, 1)
        queue.close()
        seeds.close()
        yield from self._downwards(large, large_lcp, size)

    def _downwards(self, large: np.ndarray, large_lcp: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        text, passed, queue = self.text, self._passed(), Queue(self.scratch)
        carried = 0  # common prefix of the next L suffix and the one above it
        while size or queue.peek() is not None:
            key = min(k for k in (queue.peek(), -int(text[large[size - 1]]) if size else None) if k is not None)
            last = None
            while queue.peek() == key:
                pos, lcp = queue.pop()
                if last is None:
                    lcp = np.append(0, lcp[1:])
                last = pos[-1:]
                yield pos, lcp
                self._send(queue, passed, pos, lcp, 1, -1)
            first = True
            while size and -int(text[large[size - 1]]) == key:
                a = max(0, size - self.scratch.block)
                pos = np.asarray(large[a:size])[::-1]
                pos = pos[: int(np.argmax(np.append(-text[pos].astype(np.int64), key + 1) != key))]
                own = np.asarray(large_lcp[size - len(pos) : size])[::-1].astype(np.int64)
                if first:
                    carried = 0 if last is None else int(common_prefix(text, last, pos[:1], self.limit)[0])
                lcp, carried, first = np.append(carried, own[:-1]), int(own[-1]), False
                size -= len(pos)
                yield pos, lcp
                self._send(queue, passed, pos, lcp, 1, -1)
        queue.close()


def _equal_substrings(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Of the pairs ``alive``: those whose substrings of ``length`` symbols are equal."""
    k = 0
    done = []
    while len(alive):
        alive = alive[text[a[alive] + k] == text[b[alive] + k]]
        k += 1
        over = length[alive] <= k
        done.append(alive[over])
        alive = alive[~over]
    return np.concatenate(done) if done else alive


def _doubled(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names, by prefix doubling in memory."""
    rank, k = np.asarray(names, np.int64), 1
    n = len(rank)
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - k] = rank[k:] + 1
        values, rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)
        if len(values) == n or k >= n:
            return np.argsort(rank, kind="stable")
        k *= 2


def _leftmost(text: np.ndarray, small: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Places of the leftmost-S suffixes, in the text's order."""
    found = lambda a, b: np.flatnonzero(np.asarray(small[a + 1 : b + 1]) & ~np.asarray(small[a:b]) & 1) + a + 1
    n = len(text) - 1
    out, at = scratch.array(sum(len(found(a, b)) for a, b in scratch.blocks(n)), np.int64), 0
    for a, b in scratch.blocks(n):
        got = found(a, b)
        out[at : at + len(got)] = got
        at += len(got)
    return out


def _in_order(text: np.ndarray, small: np.ndarray, scratch: Scratch) -> np.ndarray:
    """The leftmost-S suffixes in order: their substrings by induction, the string of the substrings' names by recursion."""
    lms = _leftmost(text, small, scratch)
    n, seeds = len(lms), Queue(scratch)
    for a, b in scratch.blocks(n):
        seeds.push(text[lms[a:b]].astype(np.int64), np.asarray(lms[a:b]), np.zeros(b - a, np.int64))
    by_substring, at = scratch.array(n, np.int64), n - 1
    by_substring[0] = len(text) - 1  # the end symbol is the least
    for pos, _ in Induction(text, small, scratch, None, 0).run(seeds):
        # leftmost: S, and what stands before is L
        inner = pos[pos > 0]
        got = inner[(small[inner] == 1) & (small[inner - 1] == 0)]
        by_substring[at - len(got) + 1 : at + 1] = got[::-1]
        at -= len(got)
    names, name, before = scratch.array(n, np.int64), 0, None
    for a, b in scratch.blocks(n):
        here = np.asarray(by_substring[a:b])
        mine = np.searchsorted(lms, here)
        length = np.where(mine + 1 < n, lms[np.minimum(mine + 1, n - 1)] - here + 1, 1)
        if before is None:
            left, left_length = here[:-1], length[:-1]
            right, right_length, offset = here[1:], length[1:], 1
        else:
            left, left_length = np.append(before[0], here[:-1]), np.append(before[1], length[:-1])
            right, right_length, offset = here, length, 0
        same = np.zeros(len(right), bool)
        same[_equal_substrings(text, left, right, right_length, np.flatnonzero(left_length == right_length))] = True
        own = name + np.append(np.zeros(offset, np.int64), np.cumsum(~same))[: len(here)]
        names[mine] = own
        name, before = int(own[-1]), (here[-1:], length[-1:])
    out = scratch.array(n, np.int64)
    if name + 1 == n:  # all differ: their names are their places
        for a, b in scratch.blocks(n):
            out[names[a:b]] = lms[a:b]
        return out
    if n * 64 <= scratch.memory:
        out[:] = np.asarray(lms)[_doubled(names)]
        return out
    at = n
    for pos, _ in _descending(names, scratch, None, 0):
        out[at - len(pos) : at] = lms[pos][::-1]
        at -= len(pos)
    return out


def _descending(text: np.ndarray, scratch: Scratch, symbols: int | None, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, common prefixes with the next greater) of all suffixes, in pieces, the greatest first."""
    n = len(text)
    if n > 1:
        small = _types(text, scratch)
        order, seeds, before = _in_order(text, small, scratch), Queue(scratch), None
        for a, b in scratch.blocks(len(order)):
            here = np.asarray(order[a:b])
            left = np.append(before if before is not None else here[:1], here[:-1])
            if symbols is None:
                lcp = np.zeros(len(here), np.int64)
            elif before is None:
                lcp = np.append(0, common_prefix(text, left[1:], here[1:], limit))
            else:
                lcp = common_prefix(text, left, here, limit)
            seeds.push(text[here].astype(np.int64), here, lcp)
            before = here[-1:]
        yield from Induction(text, small, scratch, symbols, limit).run(seeds)
    if n:
        yield np.array([n - 1]), np.zeros(1, np.int64)


def descending_suffixes(text: np.ndarray, memory: int = MEMORY, limit: int = 1 << 40, symbols: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The suffixes of an array of non-negative integers below ``symbols`` whose last one is its only least, the greatest first: pieces of
    (positions, common prefixes with the next greater one, up to ``limit``)."""
    with Scratch(memory) as scratch:
        yield from _descending(text, scratch, symbols or int(text.max()) + 1, min(limit, (1 << 31) - 1))


def suffix_array(text: np.ndarray, memory: int = MEMORY, limit: int = 1 << 30) -> tuple[np.ndarray, np.ndarray]:
    """``(sa, lcp)``, whole, in ascending order; ``lcp[i]``: of sa[i - 1] and sa[i]."""
    pieces = list(descending_suffixes(np.asarray(text), memory, limit))
    pos, lcp = (np.concatenate([p[i] for p in pieces])[::-1] for i in (0, 1))
    return pos, np.append(0, lcp[:-1])
