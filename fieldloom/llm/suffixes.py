"""Suffix arrays of byte blocks by two-stage sorting, to a fixed depth."""

from __future__ import annotations

import numpy as np

#: Ends a string of a block.  Bytes are raised by one, so no symbol is 0; valid UTF-8 stays below.
STOP = 0xFF


def block(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The strings as one array of symbols, each ended by STOP; where each begins."""
    whole = np.frombuffer(b"\xfe".join([*strings, b""]), dtype=np.uint8) + np.uint8(1)
    starts = np.cumsum([0, *(len(s) + 1 for s in strings[:-1])])
    return whole, starts


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; a run of one symbol has the type of its end."""
    n = len(text)
    change = np.flatnonzero(text[:-1] != text[1:])
    rises = text[change] < text[change + 1]
    # the last run has nothing behind it: larger than its successor
    runs = np.diff(np.concatenate(([-1], change, [n - 1])))
    return np.repeat(np.concatenate((rises, [False])), runs)


def _places(keys: np.ndarray) -> np.ndarray:
    """The place of each key in the order of the different ones, from 1."""
    order = np.argsort(keys)
    ordered = keys[order]
    out = np.empty(len(keys), dtype=np.uint64)
    out[order] = np.cumsum(np.concatenate(([True], ordered[1:] != ordered[:-1]))).astype(np.uint64)
    return out


def prefix_ranks(text: np.ndarray, depth: int) -> tuple[np.ndarray, int]:
    """Ranks of all suffixes by their first ``size`` symbols, and ``size``: at most ``depth``, half of it at least.

    Equal ranks mean equal symbols; 0 stands for what lies behind the end.  There is one
    rank more for each place up to ``depth`` behind it.  A rank of three times the length is that of
    three ranks side by side, as long as they fit into a word, else of two.
    """
    n, size = len(text), min(8, depth)
    padded = np.concatenate((text, np.zeros(8, dtype=np.uint8))).astype(np.uint64)
    keys = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        keys = keys << np.uint64(8) | padded[j : j + n]
    beyond = np.zeros(depth, dtype=np.uint64)
    ranks = np.concatenate((_places(keys), beyond))
    bits = np.uint64((n + 1).bit_length())
    while 2 * size < depth:
        times = 3 if 3 * size <= depth and 3 * int(bits) <= 64 else 2
        keys = ranks[:n]
        for j in range(1, times):
            keys = keys << bits | ranks[j * size : j * size + n]
        ranks = np.concatenate((_places(keys), beyond))
        size *= times
    return ranks, size


def suffix_array(text: np.ndarray, depth: int, ranked: tuple[np.ndarray, int] | None = None) -> np.ndarray:
    """All suffixes in the order of their first ``depth`` symbols (more may count).

    First stage: the suffixes smaller than their successors are sorted directly, by the
    ranks of the first and the last symbols of their prefixes.  Second
    stage: a scan of the buckets by first symbol, from the smallest on, induces the
    others: whoever precedes the next suffix in order and is larger than it is the next
    in its own bucket.  A bucket is scanned as a whole, its runs of one symbol in rounds.
    """
    n = len(text)
    small = _types(text)
    direct = np.flatnonzero(small)
    if len(direct):
        ranks, size = ranked or prefix_ranks(text, depth)
        direct = direct[np.argsort(ranks[direct] << np.uint64(32) | ranks[direct + (depth - size)])]
    first = text[direct]
    ends = np.searchsorted(first, np.arange(257))  # direct is in order of its first symbols
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    # the last suffix precedes nothing; it is the smallest of the large ones that start with its symbol
    induced[int(text[-1])].append(np.array([n - 1]))
    order = []
    for symbol in range(256):
        found = [a for a in induced[symbol] if len(a)]
        front = np.concatenate(found) if found else np.empty(0, dtype=np.int64)
        rounds = []
        while len(front):
            rounds.append(front)
            before = front[front > 0] - 1
            front = before[(text[before] == symbol) & ~small[before]]
        here = np.concatenate((*rounds, direct[ends[symbol] : ends[symbol + 1]]))
        if not len(here):
            continue
        order.append(here)
        before = here[here > 0] - 1
        before = before[~small[before] & (text[before] > symbol)]
        if len(before):
            symbols = text[before]
            sort = np.argsort(symbols, kind="stable")
            before, symbols = before[sort], symbols[sort]
            cuts = np.flatnonzero(np.diff(symbols)) + 1
            for part in np.split(before, cuts):
                induced[int(text[part[0]])].append(part)
    return np.concatenate(order)


def repeated_starts(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the strings of ``depth`` symbols that also start earlier in the block, ascending.

    Neighbours in order share a string where their prefixes agree.  Strings end at STOP: what
    reaches over one does not count.
    """
    n = len(text)
    if n <= depth:
        return np.empty(0, dtype=np.int64)
    ranks, size = ranked = prefix_ranks(text, depth)
    order = suffix_array(text, depth, ranked)
    stops = np.append(np.flatnonzero(text == STOP), n)
    ends = np.repeat(stops, np.diff(np.concatenate(([-1], stops))))[:n]
    order = order[ends[order] - order >= depth]
    if not len(order):
        return order
    head, tail = ranks[order], ranks[order + (depth - size)]
    same = (head[1:] == head[:-1]) & (tail[1:] == tail[:-1])
    heads = np.flatnonzero(np.concatenate(([True], ~same)))
    least = np.minimum.reduceat(order, heads)
    later = np.zeros(n, dtype=bool)
    later[order] = True
    later[least] = False
    return np.flatnonzero(later)
