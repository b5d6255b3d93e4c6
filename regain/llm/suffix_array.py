"""Suffix arrays by induced sorting, and permuted common prefixes, over arrays of small integers."""

from __future__ import annotations

import numpy as np

# alphabets up to this size are induced bucket by bucket with array operations, larger ones element by element
SMALL_ALPHABET = 512


def ascending(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (type S); the last symbol is the smallest and unique."""
    n = len(s)
    is_s = np.empty(n, dtype=bool)
    is_s[-1] = True
    if n > 1:
        rises = s[:-1] < s[1:]
        unlike = s[:-1] != s[1:]
        differs = np.flatnonzero(unlike)
        # an equal run has the type of the place where it ends
        is_s[:-1] = rises[differs][np.cumsum(unlike) - unlike]
    return is_s


def _spread(places: np.ndarray, symbols: np.ndarray, into: list[list[np.ndarray]]) -> None:
    """Append places to the lists of their symbols, keeping their order."""
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    cuts = np.flatnonzero(ranked[1:] != ranked[:-1]) + 1
    for part in np.split(order, cuts):
        into[int(symbols[part[0]])].append(places[part])


def _induce_buckets(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """The suffix array that the given order of leftmost-smaller suffixes induces, a bucket at a time."""
    starts = np.searchsorted(s[lms][order := np.argsort(s[lms], kind="stable")], np.arange(size + 1))
    lms = lms[order]
    falling: list[list[np.ndarray]] = [[] for _ in range(size)]
    rising: list[list[np.ndarray]] = [[] for _ in range(size)]

    def push(front: np.ndarray, symbol: int, wanted: bool, lists: list[list[np.ndarray]]) -> np.ndarray:
        """Induce from ``front``; returns what falls into the same bucket."""
        before = front[front > 0] - 1
        before = before[is_s[before] == wanted]
        symbols = s[before]
        own = symbols == symbol
        if not own.all():
            _spread(before[~own], symbols[~own], lists)
        return before[own]

    none = np.zeros(0, dtype=lms.dtype)
    for c in range(size):
        front = np.concatenate(falling[c]) if falling[c] else none
        falling[c] = [front]
        while len(front):
            front = push(front, c, False, falling)
            falling[c].append(front)
        here = lms[starts[c] : starts[c + 1]]
        if len(here):
            push(here, c, False, falling)
        falling[c] = np.concatenate(falling[c])
    for c in range(size - 1, -1, -1):
        front = np.concatenate(rising[c]) if rising[c] else none
        rising[c] = [front]
        while len(front):
            front = push(front, c, True, rising)
            rising[c].append(front)
        if len(falling[c]):
            push(falling[c][::-1], c, True, rising)
    out = [np.array([len(s) - 1], dtype=lms.dtype)]
    for c in range(size):
        out.append(falling[c])
        if rising[c]:
            out.append(np.concatenate(rising[c])[::-1])
    return np.concatenate(out)


def _induce_one_by_one(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    n = len(s)
    # by place: the bucket its predecessor is induced into, -1 where it is of the other type or there is none; the
    # entry at -1 stands for places of the array that are still empty
    before = np.full((2, n + 1), -1, dtype=np.int64)
    before[0, 1:n] = np.where(is_s[:-1], -1, s[:-1])
    before[1, 1:n] = np.where(is_s[:-1], s[:-1], -1)
    falls, rises = before.tolist()
    counts = np.bincount(s, minlength=size)
    ends = np.cumsum(counts)
    heads = (ends - counts).tolist()
    # the given suffixes from the end of their buckets down
    turned = lms[::-1]
    order = np.argsort(s[turned], kind="stable")
    symbol = s[turned][order]
    nth = np.arange(len(order)) - np.searchsorted(symbol, symbol)
    start = np.full(n, -1, dtype=np.int64)
    start[ends[symbol] - 1 - nth] = turned[order]
    array = start.tolist()
    for k in array:  # meets what it puts further on
        c = falls[k]
        if c >= 0:
            h = heads[c]
            array[h] = k - 1
            heads[c] = h + 1
    tails = ends.tolist()
    for k in reversed(array):
        c = rises[k]
        if c >= 0:
            h = tails[c] - 1
            array[h] = k - 1
            tails[c] = h
    array[0] = n - 1
    return np.array(array, dtype=np.int64)


def _names(s: np.ndarray, is_s: np.ndarray, ordered: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers of the leftmost-smaller substrings, in text order; equal substrings share one."""
    n = len(s)
    end = np.full(n, n - 1, dtype=np.int64)
    end[lms[:-1]] = lms[1:]
    a, b = ordered[:-1], ordered[1:]
    length = end[a] - a
    same = length == end[b] - b
    open_pairs = np.flatnonzero(same)
    offset = 0
    while len(open_pairs):
        x, y = a[open_pairs] + offset, b[open_pairs] + offset
        agree = (s[x] == s[y]) & (is_s[x] == is_s[y])
        same[open_pairs[~agree]] = False
        open_pairs = open_pairs[agree & (offset < length[open_pairs])]
        offset += 1
    rank = np.concatenate([[0], np.cumsum(~same)])
    name = np.empty(n, dtype=np.int64)
    name[ordered] = rank
    return name[lms], int(rank[-1]) + 1


def _doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``names``, whose last name occurs only there, by ``depth`` names at least: what is equal in
    some names is told apart by the ranks of what follows, twice as many names each round."""
    m = len(names)
    order = np.argsort(names, kind="stable")
    places, keys = np.arange(m), names[order]
    rank, step = np.empty(m, dtype=np.int64), 0
    while True:
        fresh = np.ones(len(places), dtype=bool)
        fresh[1:] = keys[1:] != keys[:-1]
        heads = np.flatnonzero(fresh)
        sizes = np.diff(np.append(heads, len(places)))
        rank[order[places]] = np.repeat(places[heads], sizes)
        places = places[np.repeat(sizes > 1, sizes)]
        step = 2 * step or 1
        if not len(places) or step >= depth:
            return order
        open_ = order[places]
        keys = rank[open_] * m + rank[open_ + step]
        by = np.argsort(keys)
        order[places], keys = open_[by], keys[by]


def suffix_array(s: np.ndarray, size: int, depth: int | None = None) -> np.ndarray:
    """Suffix array of ``s``, whose symbols are below ``size`` and whose last symbol, 0, occurs only there.

    Suffixes are classified, the leftmost-smaller substrings sorted (by doubling where names repeat), and the whole array
    induced from their order. With a ``depth``, suffixes equal in that many symbols may come in any order.
    """
    induce = _induce_buckets if size <= SMALL_ALPHABET else _induce_one_by_one
    if len(s) == 1:
        return np.zeros(1, dtype=np.int64)
    if size <= SMALL_ALPHABET:
        s = s.astype(np.uint16)  # which is sorted by its digits
    is_s = ascending(s)
    is_lms = np.zeros(len(s), dtype=bool)
    is_lms[1:] = is_s[1:] & ~is_s[:-1]
    lms = np.flatnonzero(is_lms)
    if size <= SMALL_ALPHABET and len(s) < 1 << 31:
        lms = lms.astype(np.int32)
    first = induce(s, is_s, lms, size)
    ordered = first[is_lms[first]]
    names, distinct = _names(s, is_s, ordered, lms)
    if distinct < len(lms):
        # from one such suffix to the next are two symbols at least
        ordered = lms[_doubled(names, len(names) if depth is None else depth // 2 + 1)]
    return induce(s, is_s, ordered, size)


def permuted_common_prefixes(text: bytes, array: np.ndarray, limit: int) -> np.ndarray:
    """Per text position, the length of the prefix shared with the suffix before it in ``array``, up to
    ``limit``; the first suffix of the array has 0. ``array`` may list some of the positions only."""
    raw = np.frombuffer(text + bytes(limit + 8), np.uint8)
    words = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    out = np.zeros(len(text) + 1, dtype=np.int64)
    a, b = array[:-1], array[1:]
    active = np.arange(len(a))
    for at in range(0, limit, 8):
        x, y = words[a[active] + at], words[b[active] + at]
        differ = x ^ y
        stop = np.flatnonzero(differ)
        if len(stop):
            low = differ[stop] & (~differ[stop] + np.uint64(1))  # lowest set bit: the first byte that differs
            out[b[active[stop]]] = at + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        active = active[differ == 0]
    out[b[active]] = limit
    return np.minimum(out, limit)
