"""Suffix order and common prefixes by external induced sorting.

Suffixes that start smaller than their left neighbour's (S*) are sorted first: their
substrings are named and the string of names is sorted by the same method. All others
are induced from them: a priority queue holds tuples (first symbol, rank of the suffix
one further right, position). Tuples come out smallest first, and each one that comes
out puts the suffix one further left into the queue if it is of the type being induced.
The queue takes out as many tuples at once as cannot be overtaken by what they put in.
Tuples wait in files by range of symbols, and orders and range minima beyond ``memory``
live in files. The text, its types, names and measured prefixes are in memory, some tens
of bytes per symbol, so callers bound the text. The files have no name: they belong to
the task and vanish with it.
"""

from __future__ import annotations

import tempfile

import numpy as np


class Scratch:
    """Arrays in memory up to ``memory`` bytes in all, and in unnamed files beyond."""

    def __init__(self, memory: int = 256 << 20):
        self.memory, self.used = memory, 0

    def empty(self, shape, dtype) -> np.ndarray:
        size = int(np.prod(shape)) * np.dtype(dtype).itemsize
        if size and self.used + size > self.memory:
            return np.memmap(tempfile.TemporaryFile(), dtype=dtype, mode="w+", shape=shape)
        self.used += size
        return np.empty(shape, dtype)

    def free(self, *arrays: np.ndarray) -> None:
        self.used -= sum(a.nbytes for a in arrays if not isinstance(a, np.memmap))


class TupleQueue:
    """Tuples (position, rank) by range of symbols, each range in the order of arrival, which is by rank.

    What is put in is staged in memory and written behind the others of its range when
    the stage is full; a range is read back when its turn comes."""

    def __init__(self, edges: np.ndarray, stage: int = 1 << 18):
        self.edges, self.stage, self.n = edges, stage, 0
        self.fresh: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.parts: list[list[tuple[int, int]]] = [[] for _ in edges]
        self.recent: list[list[np.ndarray]] = [[] for _ in edges]
        self.file = None

    def put(self, symbols: np.ndarray, position: np.ndarray, rank: np.ndarray) -> None:
        if len(position):
            self.fresh.append((np.searchsorted(self.edges, symbols, side="right"), position, rank))
            self.n += len(position)
            if self.n > self.stage:
                self._sort()
                self._spill()

    def _sort(self) -> None:
        if self.fresh:
            of, position, rank = (np.concatenate(x) for x in zip(*self.fresh))
            order = np.argsort(of, kind="stable")
            both = np.stack([position[order], rank[order]], axis=1)
            ends = np.cumsum(np.bincount(of, minlength=len(self.parts)))
            for k in np.unique(of).tolist():
                self.recent[k].append(both[ends[k - 1] if k else 0 : ends[k]])
            self.fresh, self.n = [], 0

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for k, some in enumerate(self.recent):
            for x in some:
                self.parts[k].append((self.file.tell(), len(x)))
                self.file.write(x.astype(np.int64).tobytes())
            self.recent[k] = []

    def take(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        self._sort()
        found = []
        for at, n in self.parts[k]:
            self.file.seek(at)
            found.append(np.frombuffer(self.file.read(16 * n), np.int64).reshape(-1, 2))
        found += self.recent[k]
        self.parts[k], self.recent[k] = [], []
        both = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        return both[:, 0], both[:, 1]


class RangeMinimum:
    """Minima over ranges of a growing array of small numbers: per power of two, the minimum
    of that many entries up to each place."""

    def __init__(self, n: int, scratch: Scratch):
        self.levels = scratch.empty((max(1, n.bit_length()), n), np.uint8)

    def append(self, at: int, values: np.ndarray) -> None:
        end = at + len(values)
        self.levels[0, at:end] = values
        for k in range(1, len(self.levels)):
            half = 1 << (k - 1)
            if half > end:
                break
            low, lo = self.levels[k - 1, at:end].copy(), max(at, half)
            if lo < end:
                np.minimum(low[lo - at :], self.levels[k - 1, lo - half : end - half], out=low[lo - at :])
            self.levels[k, at:end] = low

    def query(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        k = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        return np.minimum(self.levels[k, last], self.levels[k, first + (np.int64(1) << k) - 1])


def _types(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """S-type flags (suffix smaller than its right neighbour) and the last place of each run."""
    ends = np.append(np.flatnonzero(t[1:] != t[:-1]), len(t) - 1)
    lens = np.diff(np.append(-1, ends))
    up = np.append(t[ends[:-1]] < t[ends[:-1] + 1], True)
    return np.repeat(up, lens), np.repeat(ends, lens)


def _whole_range(t, target, position, source, seeds, high, rank):
    """Order of all suffixes of a range of symbols, those included that the range itself induces.

    A suffix sorts by its symbol and the place of the one it was induced from. Where
    that one is of the range too, its place is not known yet: places are taken from the
    last order and sorted again until they stay, once per link of the longest chain.
    Returns the positions in order, which of them induce beyond the range, and all symbols induced."""
    layers, parents, n = [position, seeds], [], 0
    new = np.concatenate([position, seeds])
    while len(new):
        left = new - 1
        near = np.flatnonzero((left >= 0) & target[left] & (t[left] < high))
        parents.append(n + near)
        n += len(new)
        new = left[near]
        layers.append(new)
    position = np.concatenate(layers)
    parent = np.concatenate(parents) if parents else np.zeros(0, np.int64)
    first = len(source) + len(seeds)
    key = t[position].astype(np.int64) << 1
    key[len(source) : first] |= 1
    by = np.concatenate([source, np.arange(len(seeds)), np.full(len(position) - first, rank)]).astype(np.int64)
    order = np.lexsort((by, key))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    # a suffix alone with its symbol keeps its place, and so do those whose sources are all known
    new = np.append(True, key[order][1:] != key[order][:-1])[: len(order)]
    group = np.cumsum(new) - 1
    loose = np.bincount(group, minlength=1)[group] > 1
    loose &= np.bincount(group, weights=order >= first, minlength=1)[group] > 0
    slots, some = np.flatnonzero(loose), order[loose]
    while True:
        now = rank + place[parent]
        if np.array_equal(now, by[first:]):
            break
        by[first:] = now
        some = some[np.lexsort((by[some], key[some]))]
        place[some] = slots
    order[slots] = some
    position = position[order]
    left = position - 1
    to = t[left].astype(np.int64)
    return position, np.flatnonzero((left >= 0) & target[left] & (to >= high)), to


def induce(t, target, seeds, ends, scratch: Scratch, seed_common=None, cap: int = 0, room: int = 1 << 12):
    """Order of the ``target`` suffixes and the ``seeds`` (which come in order, and last among
    the suffixes with their first symbol). With ``cap``, also the common prefix of each with
    the one before it, up to ``cap``: one more than the least common prefix between the two
    suffixes that they were induced from."""
    total = int(target.sum()) + len(seeds)
    out = scratch.empty(total, np.int64)
    common = RangeMinimum(total, scratch) if cap else None
    counts = np.cumsum(np.bincount(t[target]))
    # ranges of symbols with about ``room`` suffixes; a symbol with more has a range of its own
    full = np.searchsorted(counts, np.arange(room, counts[-1] if len(counts) else 0, room), side="left")
    edges = np.unique(np.concatenate([full, full + 1]))
    edges = np.append(edges[edges > 0], np.iinfo(np.int64).max)  # where each range ends
    queue = TupleQueue(edges)
    seed_symbol = t[seeds].astype(np.int64)
    rank, seed_at = 0, 0
    last = (-1, -1, -1, False)  # symbol, position, rank of its source, seed: of the last suffix put out

    def emit(position, key, source, seed_nr) -> np.ndarray:
        nonlocal rank, last
        n = len(position)
        out[rank : rank + n] = position
        if cap:
            symbol, is_seed = key >> 1, (key & 1).astype(bool)
            before = lambda x, first: np.append(first, x[:-1])
            same = symbol == before(symbol, last[0])
            was_seed, was, was_from = before(is_seed, last[3]).astype(bool), before(position, last[1]), before(source, last[2])
            value = np.zeros(n, np.int64)
            both = same & ~is_seed
            if both.any():
                value[both] = 1 + common.query(was_from[both] + 1, source[both])
            seam = same & is_seed & ~was_seed
            value[seam] = np.minimum(ends[position[seam]] - position[seam], ends[was[seam]] - was[seam]) + 1
            both = same & is_seed & was_seed
            value[both] = seed_common[seed_nr[both]]
            common.append(rank, np.minimum(value, cap).astype(np.uint8))
            last = (int(symbol[-1]), int(position[-1]), int(source[-1]), bool(is_seed[-1]))
        rank += n
        return np.arange(rank - n, rank)

    for k in range(len(edges)):
        position, source = queue.take(k)
        high = edges[k]
        seed_end = seed_at + int(np.searchsorted(seed_symbol[seed_at:], high, side="left"))
        if not cap:
            found = _whole_range(t, target, position, source, seeds[seed_at:seed_end], high, rank)
            position, far, to = found
            out[rank : rank + len(position)] = position
            queue.put(to[far], position[far] - 1, rank + far)
            rank, seed_at = rank + len(position), seed_end
            continue
        order = np.argsort(t[position], kind="stable")
        position, source = position[order], source[order]
        key = np.concatenate([t[position].astype(np.int64) << 1, seed_symbol[seed_at:seed_end] << 1 | 1])
        position = np.concatenate([position, seeds[seed_at:seed_end]])
        source = np.concatenate([source, np.full(seed_end - seed_at, -1)])
        nr = np.concatenate([np.full(len(order), -1), np.arange(seed_at, seed_end)])
        order = np.argsort(key, kind="stable")
        position, source, key, nr = position[order], source[order], key[order], nr[order]
        seed_at, look = seed_end, 1024
        while len(position):
            p, c = position[:look], key[:look] >> 1
            left = p - 1
            goes = (left >= 0) & target[left]
            to = np.where(goes, t[left], np.iinfo(np.int64).max).astype(np.int64)
            bad = np.flatnonzero(np.minimum.accumulate(to) <= c)
            if not len(bad) and len(p) == len(position):
                n = len(p)
            else:
                n = int(np.searchsorted(c, c[bad[0]] if len(bad) else c[-1], side="left"))
                if not n and not len(bad):
                    look *= 4  # one symbol fills what was looked at, and nothing falls into it so far
                    continue
                if not n:
                    # the first symbol induces itself: its tuples so far come out, and what they put in follows them
                    n = int(np.searchsorted(key, (c[0] << 1) + 1, side="left"))
                    left = position[:n] - 1
                    goes = (left >= 0) & target[left]
                    to = np.where(goes, t[left], np.iinfo(np.int64).max).astype(np.int64)
            goes, to = goes[:n], to[:n]
            ranks = emit(position[:n], key[:n], source[:n], nr[:n])
            new, new_rank, to = position[:n][goes] - 1, ranks[goes], to[goes]
            position, source, key, nr = position[n:], source[n:], key[n:], nr[n:]
            near = to < high
            queue.put(to[~near], new[~near], new_rank[~near])
            if near.any():
                order = np.argsort(to[near], kind="stable")
                new, new_rank, new_key = new[near][order], new_rank[near][order], to[near][order] << 1
                where = np.searchsorted(key, new_key, side="right")
                position, source = np.insert(position, where, new), np.insert(source, where, new_rank)
                key, nr = np.insert(key, where, new_key), np.insert(nr, where, np.full(len(new), -1))
            look = max(1024, 4 * n)
    return out, (common.levels[0] if cap else None)


def _names(t: np.ndarray, s_type: np.ndarray, star: np.ndarray) -> np.ndarray:
    """Rank of each S* substring (up to the next S* place), equal ones the same: sorted by words
    of several symbols, longer ones word by word as long as they tie."""
    symbol = (t.astype(np.int64) << 1) | s_type
    bits = int(symbol.max()).bit_length() + 1
    per = max(1, 62 // bits)
    length = np.append(np.diff(star), 0) + 1

    def word(k: np.ndarray, depth: int) -> np.ndarray:
        out = np.zeros(len(k), np.int64)
        for j in range(depth, depth + per):
            inside = j < length[k]
            out = out << bits | np.where(inside, symbol[np.minimum(star[k] + j, len(t) - 1)] + 1, 0)
        return out

    def ranked(values: np.ndarray) -> np.ndarray:
        """Number of smaller ones."""
        order = np.argsort(values, kind="stable")
        new = np.append(True, values[order][1:] != values[order][:-1])
        first = np.flatnonzero(new)
        out = np.empty(len(values), np.int64)
        out[order] = np.repeat(first, np.diff(np.append(first, len(values))))
        return out

    name = ranked(word(np.arange(len(star)), 0))
    depth, open_ = per, np.flatnonzero(length > per)
    while len(open_):
        size = np.bincount(name, minlength=1)
        open_ = open_[(length[open_] > depth) & (size[name[open_]] > 1)]
        if not len(open_):
            break
        order = np.lexsort((word(open_, depth), name[open_]))
        k = open_[order]
        w, g = word(k, depth), name[k]
        group = np.append(True, g[1:] != g[:-1])
        new = group | np.append(True, w[1:] != w[:-1])
        start = np.maximum.accumulate(np.where(group, np.arange(len(k)), 0))
        first = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
        name[k] = g + first - start
        depth += per
    return name


def _measured(t: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of the suffixes at a and b, up to ``cap``, eight bytes at a time: eight symbols below 256, or four."""
    wide = np.zeros(len(t) + cap + 8, np.uint8 if t.max(initial=0) < 256 else np.uint16)
    wide[: len(t)] = t
    per, bits = 8 // wide.itemsize, 8 * wide.itemsize
    words = np.lib.stride_tricks.sliding_window_view(wide, per).copy().view(np.uint64)[:, 0]
    out, left = np.zeros(len(a), np.int64), np.arange(len(a))
    for d in range(0, cap, per):
        x = words[a + d] ^ words[b + d]
        differ = x != 0
        part = x[differ]
        part = np.bitwise_count((part & (~part + np.uint64(1))) - np.uint64(1))  # zero bits below the first that differs
        out[left[differ]] = d + part // bits
        a, b, left = a[~differ], b[~differ], left[~differ]
    out[left] = cap
    return np.minimum(out, cap)


def suffixes(t: np.ndarray, scratch: Scratch, cap: int = 0, room: int = 1 << 12):
    """Positions of all suffixes of ``t`` in descending order, without the last one, and with
    ``cap`` the common prefix of each with the one before it. ``t`` ends with its only 0.
    With ``cap``, at most 254, symbols are below 2**16."""
    t = np.asarray(t)
    s_type, ends = _types(t)
    star = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    name = _names(t, s_type, star)
    if len(star) == len(np.unique(name)):
        star = star[np.argsort(name)]
    else:
        inner, _ = suffixes(name, scratch, room=4 * room)
        star = np.append(star[-1], star[inner[::-1]])
    common = None
    if cap:
        common = np.append(0, _measured(t, star[:-1], star[1:], cap)) if len(star) else None
    low, low_common = induce(t, ~s_type, star, ends, scratch, common, cap, room)
    kept = np.flatnonzero(~s_type[low])
    seeds = low[kept][::-1]
    if cap:
        # from after one kept suffix up to the next
        least = np.minimum.reduceat(low_common[: kept[-1] + 1], kept[:-1] + 1) if len(kept) > 1 else np.zeros(0, np.uint8)
        common = np.append(0, least[::-1]).astype(np.int64)
    s_type = s_type.copy()
    s_type[-1] = False  # the end is smaller than all; nothing induces it
    top = t.max()
    return induce(top - t, s_type, seeds, ends, scratch, common, cap, room)
