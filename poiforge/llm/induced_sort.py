"""External suffix sorting by induction: suffixes and their common prefixes, for texts far larger than the memory budget.

A suffix is S or L by its comparison with the next one; S* is an S suffix after an L suffix. The substrings from one S* place to the next
are sorted by an external merge sort and named; the string of names, at most half as long, is sorted by the same method. That gives
the S* suffixes in order, with common prefixes: so many equal names are so many characters, and what is left to compare lies
inside one substring. Two sweeps induce the rest. Ascending over first characters, every suffix puts the L suffix in front of it
into the queue of that one's character; descending, likewise for S suffixes.

Queues carry tuples (suffix, characters shared with the one before it in the queue). If x and y are taken one after the other and
both put a suffix into one queue, these share one character more than x and y, which is the least value between them in the
sweep; so no text is compared. A sweep meets suffixes in order, so a queue is first in, first out, and the queues in the order of their
characters are one priority queue. A character with more tuples than the budget has a file of its own, which is read and
lengthened at the same time; the others share runs on disk, sorted by ranges of characters that fit the budget when their turn comes.

Only `memory` tuples and blocks of `BULK` are in memory. Texts and their names are memory-mapped files, read by place, whose pages are let
go again when about `RESIDENT` bytes of them may be mapped. All files are nameless ones in the executor's own Spark scratch folder, as
those of a spilling sort, and end with the task.
"""

from __future__ import annotations

import mmap
import os
import tempfile
import weakref
from collections.abc import Callable, Iterator

import numpy as np

#: Tuples that the queues, or an external merge sort, hold in memory.
MEMORY = 1 << 18
#: Suffixes of one vectorised step.
BULK = 1 << 15
#: Bytes of files that stay mapped, about.
RESIDENT = 160 << 20
#: Names that are sorted without files.
BASE = 1 << 10
_SHIFT, _LOW = 20, (1 << 20) - 1
#: floor(log2(i))
_LOG = np.zeros(BULK + 2, np.int64)
_LOG[2:] = np.floor(np.log2(np.arange(2, BULK + 2))).astype(np.int64)


class Work:
    """What a sort has used: recursion depth, and bytes written to queues and runs; and the files that it has mapped."""

    def __init__(self, memory: int = MEMORY, bulk: int = BULK, base: int = BASE):
        self.memory, self.bulk, self.base = memory, min(bulk, BULK, memory), max(base, 4)
        self.depth = self.written = self.touched = 0
        self.maps: list[weakref.ref] = []

    def array(self, n: int, kind) -> np.ndarray:
        """A zeroed array in a memory-mapped file without a name."""
        with _file() as f:
            f.truncate(max(n, 1) * np.dtype(kind).itemsize)
            return self._mapped(f, n, kind, mmap.ACCESS_WRITE)

    def _mapped(self, f, n: int, kind, access: int) -> np.ndarray:
        # several arrays are alive at once; an array keeps its map alive
        pages = mmap.mmap(f.fileno(), 0, access=access)
        self.maps = [r for r in self.maps if r() is not None] + [weakref.ref(pages)]
        return np.frombuffer(pages, kind, n)

    def touch(self, places: int) -> None:
        """So many places have been looked at, each perhaps on a page of its own. Pages that are let go are read again from the system's cache."""
        self.touched += places * mmap.PAGESIZE
        if self.touched > RESIDENT:
            self.touched = 0
            alive = [m for r in self.maps if (m := r()) is not None]
            if sum(map(len, alive)) > RESIDENT:
                for m in alive:
                    m.madvise(mmap.MADV_DONTNEED)


def _file():
    folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return tempfile.TemporaryFile(dir=folder if folder and os.path.isdir(folder) else None)


def place_kind(n: int) -> type:
    return np.int32 if n < 2**31 - 2 else np.int64


class Stream:
    """A file of tuples in two columns, written at the end and read anywhere."""

    def __init__(self, kinds: tuple, work: Work):
        self.kinds, self.work, self.n = [np.dtype(k) for k in kinds], work, 0
        self.files = [_file() for _ in kinds]

    def add(self, *columns: np.ndarray) -> None:
        for f, kind, c in zip(self.files, self.kinds, columns, strict=True):
            raw = memoryview(np.ascontiguousarray(c, kind)).cast("B")
            self.work.written += len(raw)
            while len(raw):
                raw = raw[os.write(f.fileno(), raw) :]
        self.n += len(columns[0])

    def read(self, lo: int, hi: int) -> list[np.ndarray]:
        return [np.frombuffer(os.pread(f.fileno(), (hi - lo) * k.itemsize, lo * k.itemsize), k) for f, k in zip(self.files, self.kinds, strict=True)]

    def array(self, column: int = 0, access: int = mmap.ACCESS_READ) -> np.ndarray:
        """A column as a mapped array."""
        return self.work._mapped(self.files[column], self.n, self.kinds[column], access)

    def backwards(self, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """From the last tuple to the first; a stored common prefix belongs to the tuple and the one that follows it in this direction."""
        before = 0
        for hi in range(self.n, 0, -block):
            place, shared = (c[::-1] for c in self.read(max(0, hi - block), hi))
            moved = np.empty_like(shared)
            moved[0], moved[1:], before = before, shared[:-1], shared[-1]
            yield place, moved


class Reader:
    """Takes tuples from an iterator of blocks in portions of any size."""

    def __init__(self, source: Iterator[tuple[np.ndarray, np.ndarray]]):
        self.source, self.held = source, None

    def take(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        got, parts = 0, []
        while got < n:
            place, shared = self.held if self.held is not None else next(self.source)
            m = min(n - got, len(place))
            parts.append((place[:m], shared[:m]))
            self.held = (place[m:], shared[m:]) if m < len(place) else None
            got += m
        if len(parts) == 1:
            return parts[0]
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.uint8))


class MergeSort:
    """External merge sort of (64-bit key, number)."""

    def __init__(self, work: Work, kind: type):
        self.work, self.kind, self.held, self.size, self.runs = work, kind, [], 0, []

    def add(self, key: np.ndarray, number: np.ndarray) -> None:
        self.held.append((key, number))
        self.size += len(key)
        if self.size >= self.work.memory:
            run = Stream((np.uint64, self.kind), self.work)
            run.add(*self._sorted())
            self.runs.append(run)

    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.held:
            return np.zeros(0, np.uint64), np.zeros(0, self.kind)
        key, number = (np.concatenate(c) for c in zip(*self.held, strict=True))
        self.held, self.size = [], 0
        order = np.argsort(key)
        return key[order], number[order]

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        last = self._sorted()
        if not self.runs:
            if len(last[0]):
                yield last
            return
        portion = max(256, self.work.memory // (len(self.runs) + 1))
        at, buffers = [0] * len(self.runs), [last]
        buffers += [(np.zeros(0, np.uint64), np.zeros(0, self.kind))] * len(self.runs)
        while True:
            bar = None
            for i, run in enumerate(self.runs, 1):
                if not len(buffers[i][0]) and at[i - 1] < run.n:
                    hi = min(run.n, at[i - 1] + portion)
                    buffers[i], at[i - 1] = tuple(run.read(at[i - 1], hi)), hi
                if at[i - 1] < run.n and (bar is None or buffers[i][0][-1] < bar):
                    bar = buffers[i][0][-1]  # what follows in this run is not smaller
            out = []
            for i, (key, number) in enumerate(buffers):
                cut = len(key) if bar is None else int(np.searchsorted(key, bar, "right"))
                if cut:
                    out.append((key[:cut], number[:cut]))
                    buffers[i] = key[cut:], number[cut:]
            if not out:
                return
            key, number = (np.concatenate(c) for c in zip(*out, strict=True))
            order = np.argsort(key)
            yield key[order], number[order]


class Queues:
    """The queues of one sweep. Ranges of characters that fit the budget share sorted runs; a larger character has its own file."""

    def __init__(self, starts: np.ndarray, crowded: np.ndarray, kinds: tuple, work: Work):
        self.starts, self.crowded, self.kinds, self.work = starts, crowded, kinds, work
        self.own: dict[int, Stream] = {}
        self.pending, self.size, self.runs = [], 0, []

    def put(self, character: np.ndarray, place: np.ndarray, shared: np.ndarray) -> None:
        """Tuples by character, and for each in the order of the sweep."""
        if not len(character):
            return
        r = np.searchsorted(self.starts, character, "right") - 1
        far = self.crowded[r]
        if far.any():
            at = np.flatnonzero(far)
            cuts = np.flatnonzero(r[at][1:] != r[at][:-1]) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
                self.stream(int(r[at[lo]])).add(place[at[lo] : at[hi - 1] + 1], shared[at[lo] : at[hi - 1] + 1])
            near = np.flatnonzero(~far)
            r, place, shared = r[near], place[near], shared[near]
        if len(r):
            self.pending.append((r, place, shared))
            self.size += len(r)
            if self.size > self.work.memory:
                r, place, shared = self._gathered()
                run = Stream(self.kinds, self.work)
                run.add(place, shared)
                self.runs.append((run, np.searchsorted(r, np.arange(len(self.starts) + 1))))
                self.pending, self.size = [], 0

    def stream(self, r: int) -> Stream:
        if r not in self.own:
            self.own[r] = Stream(self.kinds, self.work)
        return self.own[r]

    def _gathered(self) -> tuple[np.ndarray, ...]:
        columns = [np.concatenate(c) for c in zip(*self.pending, strict=True)]
        order = np.argsort(columns[0], kind="stable")
        return tuple(c[order] for c in columns)

    def take(self, r: int) -> tuple[np.ndarray, np.ndarray]:
        """All tuples of a range so far, oldest first for each character. Ranges are taken in ascending order."""
        out = [run.read(int(at[r]), int(at[r + 1])) for run, at in self.runs if at[r] < at[r + 1]]
        if self.pending:
            columns = self._gathered()
            cut = int(np.searchsorted(columns[0], r, "right"))
            out.append([columns[1][:cut], columns[2][:cut]])
            self.pending = [tuple(c[cut:] for c in columns)]
            self.size = len(self.pending[0][0])
        if not out:
            return np.zeros(0, self.kinds[0]), np.zeros(0, self.kinds[1])
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


class RangeMin:
    """Least value of any range of a short array."""

    def __init__(self, values: np.ndarray):
        self.table = [values]
        width = 1
        while 2 * width <= len(values):
            top = self.table[-1]
            longer = top.copy()
            longer[: len(top) - width] = np.minimum(top[:-width], top[width:])
            self.table.append(longer)
            width *= 2
        self.table = np.stack(self.table)

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """lo <= hi, both included."""
        k = _LOG[hi - lo + 1]
        return np.minimum(self.table[k, lo], self.table[k, hi + 1 - (1 << k)])


def extended(text: np.ndarray, a: np.ndarray, b: np.ndarray, shared: np.ndarray, depth: int) -> np.ndarray:
    """Characters that the suffixes a and b share, up to the depth, where at least so many are known."""
    shared = np.minimum(shared, depth).astype(np.int64)
    left = np.flatnonzero(shared < depth)
    while len(left):
        have = shared[left]
        left = left[(text[a[left] + have] >> 1) == (text[b[left] + have] >> 1)]
        shared[left] += 1
        left = left[shared[left] < depth]
    return shared


class Sweep:
    """One induction. Characters are counted from its beginning (for the descending sweep: from the largest); of each, first the tuples
    from its queue are taken, then the given ones."""

    def __init__(self, text: np.ndarray, sigma: int, kind: int, flip: bool, depth: int, work: Work, emit: Callable):
        self.text, self.sigma, self.kind, self.flip, self.depth, self.work, self.emit = text, sigma, kind, flip, depth, work, emit
        self.places, self.lengths = place_kind(len(text)), np.uint8 if depth < 255 else np.uint16
        # of the character that is being swept: queues it has put into, and the least common prefix since
        self.current, self.to, self.least = -1, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def character(self, value: np.ndarray) -> np.ndarray:
        c = (value >> 1).astype(np.int64)
        return self.sigma - 1 - c if self.flip else c

    def _put_before(self, place: np.ndarray, source: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(character, place, shared) of the suffixes that these put into queues, by character."""
        self.work.touch(len(place))
        before = self.text[place - 1]
        go = np.flatnonzero(((before & 1) == self.kind) & (place > 0))
        key = (self.character(before[go]) << _SHIFT) | go
        key.sort()
        c, j = key >> _SHIFT, key & _LOW
        low = RangeMin(shared)
        again = c[1:] == c[:-1]
        value = np.zeros(len(c), np.int64)
        at = np.flatnonzero(again)
        value[at + 1] = low.of(j[at] + 1, j[at + 1])
        first = np.flatnonzero(np.concatenate([[True], ~again])) if len(c) else at
        if len(self.to) and len(c) and source[0] == self.current:
            f = first[source[j[first]] == self.current]
            known = np.minimum(np.searchsorted(self.to, c[f]), len(self.to) - 1)
            hit = np.flatnonzero(self.to[known] == c[f])
            f = f[hit]
            value[f] = np.minimum(self.least[known[hit]], low.of(np.zeros(len(f), np.int64), j[f]))
        # what the next step has to know
        end = len(place) - 1
        if len(c):
            last = np.flatnonzero(np.concatenate([~again, [True]]))
            last = last[source[j[last]] == source[-1]]
        else:
            last = at
        to, least = c[last], np.full(len(last), self.depth)
        open_ = np.flatnonzero(j[last] < end)
        least[open_] = low.of(j[last][open_] + 1, np.full(len(open_), end))
        if self.current == source[-1] and len(self.to):
            old = np.flatnonzero(~np.isin(self.to, to))
            to = np.concatenate([self.to[old], to])
            least = np.concatenate([np.minimum(self.least[old], int(shared.min())), least])
            order = np.argsort(to)
            to, least = to[order], least[order]
        self.current, self.to, self.least = source[-1], to, least
        return c, (place[j] - 1).astype(self.places), np.minimum(value + 1, self.depth).astype(self.lengths)

    def run(self, counts: np.ndarray, given: np.ndarray, reader: Reader) -> None:
        """counts: tuples that come by queues; given: tuples that the reader has, both by character."""
        step, memory = self.work.bulk, self.work.memory
        total = self.work.array(self.sigma + 1, np.int64)
        for lo in range(0, self.sigma, 1 << 20):
            part = counts[lo : lo + (1 << 20)] + given[lo : lo + (1 << 20)]
            total[lo + 1 : lo + 1 + len(part)] = total[lo] + np.cumsum(part)
        starts, c = [], 0
        while c < self.sigma:
            starts.append(c)
            c = max(c + 1, int(np.searchsorted(total, total[c] + memory, "right")) - 1)
        starts = np.array(starts, np.int64)
        ends = np.append(starts[1:], self.sigma)
        queues = Queues(starts, total[ends] - total[starts] > memory, (self.places, self.lengths), self.work)
        for r, (lo, hi) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
            if queues.crowded[r]:
                self._stream(lo, queues, queues.stream(r), int(given[lo]), reader, step)
                del queues.own[r]
            elif total[lo] < total[hi]:
                self._slots(lo, hi, queues, queues.take(r), np.asarray(counts[lo:hi], np.int64), np.asarray(given[lo:hi], np.int64), reader, step)

    def _stream(self, c: int, queues: Queues, own: Stream, given: int, reader: Reader, step: int) -> None:
        at, last = 0, None
        while at < own.n:
            hi = min(own.n, at + step)
            place, shared = own.read(at, hi)
            if at == 0:
                shared = shared.copy()
                shared[0] = 0
            at, last = hi, place[-1:]
            self.emit(place, shared, True)
            queues.put(*self._put_before(place, np.full(len(place), c), shared))
        left = given
        while left:
            place, shared = reader.take(min(left, step))
            if left == given:
                shared = shared.copy()
                shared[0] = 0 if last is None else extended(self.text, last, place[:1], np.ones(1, np.int64), self.depth)[0]
            left -= len(place)
            self.emit(place, shared, False)
            queues.put(*self._put_before(place, np.full(len(place), c), shared))

    def _slots(self, lo: int, hi: int, queues: Queues, came: tuple, counts: np.ndarray, given: np.ndarray, reader: Reader, step: int) -> None:
        start = np.concatenate([[0], np.cumsum(counts + given)])
        n = int(start[-1])
        place, shared = np.full(n, -1, np.int64), np.zeros(n, self.lengths)
        source = np.repeat(np.arange(lo, hi), counts + given)
        free = start[:-1].copy()  # the next slot of each character's queue

        def fill(c: np.ndarray, p: np.ndarray, s: np.ndarray) -> None:
            fresh = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
            many = np.diff(np.append(fresh, len(c)))
            slot = np.arange(len(c)) - np.repeat(fresh - free[c[fresh] - lo], many)
            free[c[fresh] - lo] += many
            place[slot], shared[slot] = p, s

        if len(came[0]):
            c = self.character(self.text[came[0]])
            order = np.argsort(c, kind="stable")
            fill(c[order], came[0][order], came[1][order])
        have = np.flatnonzero(given)
        seam = np.zeros(0, np.int64)
        if len(have):
            slot = np.arange(int(given.sum())) + np.repeat(start[have] + counts[have] - np.concatenate([[0], np.cumsum(given[have])[:-1]]), given[have])
            place[slot], shared[slot] = reader.take(len(slot))
            seam = (start[:-1] + counts)[(counts > 0) & (given > 0)]
        queued = np.ones(n, bool)
        if len(have):
            queued[slot] = False
        edge = start[:-1][counts + given > 0]
        shared[edge] = 0

        def put(at: int, end: int, inside: int) -> None:
            """Emits slots and puts what stands before them into slots and queues; characters before `inside` have theirs already."""
            self.emit(place[at:end], shared[at:end], queued[at:end])
            c, p, v = self._put_before(place[at:end], source[at:end], shared[at:end])
            first, cut = np.searchsorted(c, (inside, hi)).tolist()
            if first < cut:
                fill(c[first:cut], p[first:cut], v[first:cut])
                shared[edge[np.isin(edge, start[c[first:cut] - lo])]] = 0
            queues.put(c[cut:], p[cut:], v[cut:])

        def seams(at: int, end: int) -> None:
            s = seam[np.searchsorted(seam, at) : np.searchsorted(seam, end)]
            if len(s):
                shared[s] = extended(self.text, place[s - 1], place[s], np.ones(len(s), np.int64), self.depth)

        first = 0
        while first < hi - lo:
            last = max(first + 1, int(np.searchsorted(start, start[first] + step, "right")) - 1)
            at, end = int(start[first]), int(start[last])
            if end - at <= step:
                # whole characters: what they put into each other is ordered at once
                if (place[at:end] < 0).any():
                    self._close(lo + first, lo + last, at, end, place, shared, start[first : last + 1], free[first:last], seams)
                else:
                    seams(at, end)
                if at < end:
                    put(at, end, lo + last)
            wide = 256
            while end - at > step and at < end:
                # one large character: as far as its slots are filled
                stop = min(end, at + wide)
                gap = place[at:stop] < 0
                size = int(gap.argmax()) if gap.any() else stop - at
                wide = min(step, max(256, 2 * size))
                seams(at, at + size)
                put(at, at + size, 0)
                at += size
                if end - at <= step:
                    while at < end:
                        gap = place[at:end] < 0
                        size = int(gap.argmax()) if gap.any() else end - at
                        seams(at, at + size)
                        put(at, at + size, 0)
                        at += size
            first = last

    def _close(self, lo: int, hi: int, at: int, end: int, place: np.ndarray, shared: np.ndarray, start: np.ndarray, free: np.ndarray, seams: Callable) -> None:
        """Fills the slots at:end of the characters lo:hi that tuples of these same characters are put into.

        First all of them are found, generation by generation. A tuple's slot follows from its source's slot among those of its character; where
        the source has none yet, it counts as the first free one of its character, which is refined until no two are equal. Common
        prefixes are then settled in the order in which those that they depend on are."""
        known = np.flatnonzero(place[at:end] >= 0)
        places, parents, characters, size = [place[at:end][known].astype(np.int64)], [], [], len(known)
        while True:
            before = self.text[places[-1] - 1]
            c = self.character(before)
            go = np.flatnonzero(((before & 1) == self.kind) & (places[-1] > 0) & (c < hi))
            if not len(go):
                break
            parents.append(go + size - len(places[-1]))
            characters.append(c[go] - lo)
            places.append(places[-1][go] - 1)
            size += len(go)
        parent, c = np.concatenate(parents), np.concatenate(characters)
        slot = np.concatenate([known + at, free[c]])
        mine = slot[len(known) :]
        while True:
            key = (c << 40) | slot[parent]
            order = np.argsort(key)
            key, by = key[order], c[order]
            fresh = np.ones(len(key), bool)
            fresh[1:] = key[1:] != key[:-1]
            group = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]]))
            offset = np.arange(len(key)) - np.repeat(group, np.diff(np.append(group, len(key))))
            offset = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0)) - np.arange(len(key)) + offset
            mine[order] = free[by] + offset
            if fresh.all():
                break
        place[mine] = np.concatenate(places[1:])
        seams(at, end)
        of = slot[parent[order]]  # sources in the order of the slots
        slots = mine[order]
        character = np.repeat(np.arange(len(start) - 1), np.diff(start))  # of each slot
        # next to a tuple of the same queue from the same window, whose source has the same character
        pair = np.flatnonzero((by[1:] == by[:-1]) & (character[of[1:] - at] == character[of[:-1] - at]))
        shared[slots] = np.minimum(1, self.depth)
        shared[slots[slots == start[by]]] = 0
        left, a, b = slots[pair + 1], of[pair] + 1, of[pair + 1]
        unsettled = np.zeros(end - at + 1, bool)
        window = np.append(shared[at:end], 0)
        left, a, b = left - at, a - at, b - at
        unsettled[left] = True
        while len(left):
            open_ = np.concatenate([[0], np.cumsum(unsettled)])
            ready = open_[b + 1] == open_[a]
            x, y = a[ready], b[ready]
            if int((y - x).sum()) < 4 * len(window):
                ends = np.stack([x, y + 1], 1).ravel()
                value = np.minimum.reduceat(window, ends)[::2]
            else:
                value = RangeMin(window).of(x, y)
            window[left[ready]] = np.minimum(value.astype(np.int64) + 1, self.depth)
            unsettled[left[ready]] = False
            left, a, b = left[~ready], a[~ready], b[~ready]
        shared[at:end] = window[:-1]


def _typed(text: np.ndarray, block: int) -> None:
    """Doubles every character and adds 1 to those of S suffixes; the last one, smaller than all, is S."""
    n = len(text)
    is_s, following = True, 0
    for hi in range(n, 0, -block):
        lo = max(0, hi - block)
        c = text[lo:hi].astype(np.int64)
        step = np.empty(len(c), np.int64)
        step[:-1] = np.sign(c[1:] - c[:-1])
        step[-1] = 1 if hi == n else np.sign(following - c[-1])
        decided = np.where(step != 0, np.arange(len(c)), len(c))
        nearest = np.minimum.accumulate(decided[::-1])[::-1]
        s = np.append(step > 0, is_s)[nearest]
        text[lo:hi] = c * 2 + s
        is_s, following = bool(s[0]), int(c[0])


def _stars(text: np.ndarray, block: int) -> Iterator[np.ndarray]:
    before = True
    for lo in range(0, len(text), block):
        s = (text[lo : lo + block] & 1).astype(bool)
        out = s.copy()
        out[1:] &= ~s[:-1]
        out[0] &= not before
        before = bool(s[-1])
        yield lo + np.flatnonzero(out)


def _named(text: np.ndarray, star: np.ndarray, sigma: int, depth: int, work: Work) -> tuple[np.ndarray, int]:
    """(names of the S* substrings in the order of the text, their number): equal for substrings equal in their first depth + 1 characters.

    An external merge sort by the first characters, then of those that are still equal by the next ones, and so on. The end of a
    substring is larger than any character: there the longer one goes on with an L suffix."""
    m, n = len(star), len(text)
    bits = int(sigma + 1).bit_length()
    inf = np.uint64((1 << bits) - 1)
    kind = place_kind(m)
    rank = work.array(m, kind)  # place of the first one of its group

    def words(i: np.ndarray, done: int, many: int) -> np.ndarray:
        work.touch(len(i))
        at = star[i].astype(np.int64)
        end = np.where(i + 1 < m, star[np.minimum(i + 1, m - 1)], at).astype(np.int64)
        out = np.zeros(len(i), np.uint64)
        for j in range(done, done + many):
            c = (text[np.minimum(at + j, n - 1)] >> 1).astype(np.uint64)
            out = (out << np.uint64(bits)) | np.where(at + j > end, inf, c)
        return out

    def open_(i: np.ndarray, done: int) -> np.ndarray:
        if done > depth:
            return np.zeros(len(i), bool)
        return (i + 1 < m) & (star[np.minimum(i + 1, m - 1)].astype(np.int64) - star[i] + 1 > done - 1)

    many, done = max(1, 63 // bits), 0
    group = int(m).bit_length()
    later = max(1, (63 - group) // bits)
    sort = MergeSort(work, kind)
    for lo in range(0, m, work.bulk):
        i = np.arange(lo, min(m, lo + work.bulk))
        sort.add(words(i, 0, many), i)
    done, first = many, True
    while sort is not None:
        again, at, head, last, head_of = None, 0, 0, None, -1
        waiting: list[np.ndarray] = []
        for key, i in sort.blocks():
            i = i.astype(np.int64)
            old = np.zeros(len(i), np.int64) if first else (key >> np.uint64(later * bits)).astype(np.int64)
            fresh = np.ones(len(i), bool)
            fresh[1:] = key[1:] != key[:-1]
            fresh[0] = last is None or key[0] != last
            # place inside the old group
            border = np.ones(len(i), bool)
            border[1:] = old[1:] != old[:-1]
            border[0] = old[0] != head_of
            where = np.arange(len(i))
            from_ = np.maximum.accumulate(np.where(border, where, -1))
            inside = np.where(from_ >= 0, where - from_, where + at)
            place = old + inside
            new = np.maximum.accumulate(np.where(fresh, place, -1))
            new = np.where(new >= 0, new, head)
            rank[i] = new
            work.touch(len(i))
            head, last, head_of = int(new[-1]), key[-1], int(old[-1])
            at = int(inside[-1]) + 1
            # groups of several that go on; the last group of a block may go on in the next one
            cut = int(np.flatnonzero(fresh)[-1]) if fresh.any() else 0
            if not fresh.any():
                waiting.append(i)
                continue
            tied = np.zeros(len(i), bool)
            tied[1:] |= ~fresh[1:]
            tied[:-1] |= ~fresh[1:]
            if waiting:
                start = int(np.flatnonzero(fresh)[0])
                whole = np.concatenate([*waiting, i[:start]])
                again = _enqueue(again, whole if len(whole) > 1 else whole[:0], open_, words, rank, done, later, bits, work, kind)
                tied[:start] = False
            again = _enqueue(again, i[:cut][tied[:cut]], open_, words, rank, done, later, bits, work, kind)
            waiting = [i[cut:]]
        whole = np.concatenate(waiting) if waiting else np.zeros(0, np.int64)
        sort = _enqueue(again, whole if len(whole) > 1 else whole[:0], open_, words, rank, done, later, bits, work, kind)
        done, first = done + later, False
    head_at = work.array(m + 1, bool)
    for lo in range(0, m, work.bulk):
        head_at[rank[lo : lo + work.bulk]] = True
    dense = work.array(m, kind)
    names = 0
    for lo in range(0, m, work.bulk):
        part = np.cumsum(head_at[lo : min(m, lo + work.bulk)])
        dense[lo : lo + len(part)] = names + part - 1
        names += int(part[-1])
    out = work.array(m, np.int32 if names < 2**30 else np.int64)
    for lo in range(0, m, work.bulk):
        out[lo : lo + work.bulk] = dense[rank[lo : lo + work.bulk]]
        work.touch(work.bulk)
    return out, names


def _enqueue(sort, i, open_, words, rank, done, later, bits, work, kind):
    """Adds the open ones of the tied substrings to the next round's merge sort, which is made when needed."""
    for lo in range(0, len(i), work.bulk):
        part = i[lo : lo + work.bulk]
        part = part[open_(part, done)]
        if len(part):
            sort = sort or MergeSort(work, kind)
            sort.add((rank[part].astype(np.uint64) << np.uint64(later * bits)) | words(part, done, later), part)
    return sort


def _by_doubling(names: np.ndarray, depth: int, work: Work) -> Stream:
    """A short string's suffixes from the largest to the smallest, with the prefix that each shares with the one before."""
    n = len(names)
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64)
    have = 1
    while have < depth and rank.max(initial=0) < n - 1:
        after = np.zeros(n, np.int64)
        after[: max(n - have, 0)] = rank[have:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        fresh = np.ones(n, bool)
        fresh[1:] = key[order][1:] != key[order][:-1]
        rank[order] = np.cumsum(fresh) - 1
        have *= 2
    order = np.argsort(rank, kind="stable")[::-1]
    shared = np.zeros(n, np.int64)
    shared[1:] = extended(names.astype(np.int64) * 2, order[:-1], order[1:], np.zeros(n - 1, np.int64), depth)
    out = Stream((place_kind(n), np.uint8 if depth < 255 else np.uint16), work)
    out.add(order, shared)
    return out


def sort_suffixes(text: np.ndarray, sigma: int, depth: int, work: Work, emit: Callable | None = None, level: int = 1) -> Stream | None:
    """Suffixes in descending order of their first `depth` characters, with the characters (up to the depth) that each shares with the one before.

    text: characters from 0 to sigma - 1, of which 0 stands at the end and nowhere else; it is overwritten. The result goes to
    emit(places, shared) block by block, or to a stream."""
    work.depth = max(work.depth, level)
    n = len(text)
    places, lengths = place_kind(n), np.uint8 if depth < 255 else np.uint16
    if emit is None:
        if n <= work.base:
            return _by_doubling(np.array(text), depth, work)
        out = Stream((places, lengths), work)
        emit = out.add
    else:
        out = None
    _typed(text, work.bulk)
    of = {kind: work.array(sigma, np.int64) for kind in "LS*"}
    stars = Stream((places,), work)
    for part in _stars(text, work.bulk):
        stars.add(part)
        np.add.at(of["*"], text[part] >> 1, 1)
    for lo in range(0, n - 1, work.bulk):
        part = text[lo : min(n - 1, lo + work.bulk)]
        np.add.at(of["S"], part[(part & 1) == 1] >> 1, 1)
        np.add.at(of["L"], part[(part & 1) == 0] >> 1, 1)
    star = stars.array()
    names, kinds = _named(text, star, sigma, depth, work)
    # every name goes on by two characters at least
    ranked = sort_suffixes(names, kinds, depth // 2 + 1, work, None, level + 1)

    def ordered() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        last = None
        for r, equal in ranked.backwards(work.bulk):
            work.touch(len(r))
            r, equal = r.astype(np.int64), equal.astype(np.int64)
            place = star[r].astype(np.int64)
            before = np.concatenate([place[:1] if last is None else last, place[:-1]])
            shared = star[np.minimum(r + equal, len(star) - 1)] - place
            if last is None:  # the smallest suffix of all has none before it
                shared[1:] = extended(text, before[1:], place[1:], shared[1:], depth)
                shared[0] = 0
            else:
                shared = extended(text, before, place, shared, depth)
            last = place[-1:]
            yield place, shared.astype(lengths)

    l_file = Stream((places, lengths), work)

    def keep(place: np.ndarray, shared: np.ndarray, queued) -> None:
        if queued is True:
            l_file.add(place, shared)
        elif queued is not False and queued.any():
            l_file.add(place[queued], shared[queued])

    Sweep(text, sigma, 0, False, depth, work, keep).run(of["L"], of["*"], Reader(ordered()))
    Sweep(text, sigma, 1, True, depth, work, lambda place, shared, _: emit(place, shared)).run(of["S"][::-1], of["L"][::-1], Reader(l_file.backwards(work.bulk)))
    emit(np.array([n - 1], places), np.zeros(1, lengths))
    return out


def repeated(text: np.ndarray, depth: int, work: Work | None = None) -> np.ndarray:
    """For every place of a text of characters below sigma = 258 (0 only at the end): do its first `depth` characters start elsewhere too?

    Characters 1 separate strings; the text is overwritten."""
    work = work or Work()
    out = work.array(len(text), bool)
    last = np.zeros(1, np.int64)

    def mark(place: np.ndarray, shared: np.ndarray) -> None:
        nonlocal last
        work.touch(len(place))
        at = np.flatnonzero(shared >= depth)
        out[place[at]] = True
        out[np.concatenate([last, place[:-1]])[at]] = True
        last = np.asarray(place[-1:], np.int64)

    sort_suffixes(text, 258, depth, work, mark)
    return out
