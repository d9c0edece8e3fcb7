"""Recompression of texts: rounds that name runs and pairs of symbols.

Every round first names maximal runs of one symbol, then every adjacent pair
whose left symbol falls in the left half and whose right symbol falls in the
right half of the round's alphabet. A name is a 64-bit mix of the names it
replaces, so equal strings get equal names on every executor without a shared
dictionary, and the halves are read off the names as well. Because the halves
are disjoint, pairs never overlap: inside two equal substrings the same pairs
are named, and the parses can differ only towards their ends.

A symbol that has grown to ``freeze`` characters takes no further part, so
symbols end up between a few and twice ``freeze`` characters long.

Every symbol knows the stretch of text that decides it: a pair is decided by its
two symbols; a symbol left alone by the neighbour it could have been paired with;
the end of a run by the next character if that differs from what a further
repetition would show, else by the next symbol. A text that holds this stretch,
wherever, has the symbol in the same place of it.
"""

from __future__ import annotations

import numpy as np

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


#: One seed for the halves of each round.
_SEEDS = np.arange(1, 65, dtype=np.uint64) * _M2


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit names (the finaliser of SplitMix64)."""
    x = x + _M1
    x = (x ^ (x >> _S30)) * _M2
    x = (x ^ (x >> _S27)) * _M3
    return x ^ (x >> _S31)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def recompress(symbols: np.ndarray, owner: np.ndarray, freeze: int, rounds: int):
    """Parse of several texts laid end to end.

    ``symbols`` are code points, ``owner`` tells the text of each. Returns the
    names, starts (in ``symbols``), lengths and texts of the final symbols, and
    the stretch [lo, hi) that decides each; it reaches beyond its text where the
    text's end decides.
    """
    n = len(symbols)
    edge = np.ones(n + 1, dtype=bool)  # where a text begins or the last one ends
    edge[1:n] = owner[1:] != owner[:-1]
    name = mix(symbols.astype(np.uint64))
    start = np.arange(n, dtype=np.int32)
    lo, hi = start.copy(), start + np.int32(1)
    for r in range(rounds):
        end = np.append(start[1:], np.int32(n))
        live = end - start < freeze
        if not live.any():
            break
        # runs
        first, final = edge[start], edge[end]
        same = name[1:] == name[:-1]
        same &= live[1:] & ~first[1:]
        # where a run ends: seen by one character, else by the next symbol
        before = np.where(first | (symbols[start - 1] != symbols[end - 1]), start - 1, np.append(lo[:1], lo[:-1]))
        after = np.where(final | (symbols.take(end, mode="clip") != symbols[start]), end + 1, np.append(hi[1:], hi[-1:]))
        if same.any():
            at = np.flatnonzero(np.append(True, ~same))
            last = np.append(at[1:], len(name)) - 1
            count = last - at + 1
            inner_lo, inner_hi = np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)
            many = np.flatnonzero(count > 1)
            name = name[at]
            name[many] = mix(name[many] ^ mix(count[many].astype(np.uint64) * _M3))
            start, end, live, first, final, before, after = start[at], end[last], live[at], first[at], final[last], before[at], after[last]
        else:
            inner_lo, inner_hi = lo, hi
        lo = np.where(live, np.minimum(inner_lo, before), inner_lo)
        hi = np.where(live, np.maximum(inner_hi, after), inner_hi)
        # pairs
        live = end - start < freeze
        left = (mix(name ^ _SEEDS[r]) & np.uint64(1)).astype(bool)
        pair = np.append(left[:-1] & ~left[1:] & live[:-1] & live[1:] & ~first[1:], False)
        keep = ~np.append(False, pair[:-1])
        at = np.flatnonzero(pair)
        # a symbol left alone is decided by the neighbour on its open side
        to_right, to_left = np.flatnonzero(live & left & ~pair), np.flatnonzero(live & ~left & keep)
        next_, prev = to_right + 1, to_left - 1
        none_right, none_left = final[to_right], first[to_left]
        new_lo, new_hi = lo.copy(), hi.copy()
        new_lo[to_right] = np.minimum(lo[to_right], np.where(none_right, lo[to_right], lo.take(next_, mode="clip")))
        new_hi[to_right] = np.maximum(hi[to_right], np.where(none_right, end[to_right] + 1, hi.take(next_, mode="clip")))
        new_lo[to_left] = np.minimum(lo[to_left], np.where(none_left, start[to_left] - 1, lo[prev]))
        new_hi[to_left] = np.maximum(hi[to_left], np.where(none_left, hi[to_left], hi[prev]))
        new_lo[at], new_hi[at] = np.minimum(lo[at], lo[at + 1]), np.maximum(hi[at], hi[at + 1])
        name[at] = mix(name[at] * _M3 + mix(name[at + 1]) + np.uint64(r))
        kept = np.flatnonzero(keep)
        name, start, lo, hi = (x.take(kept) for x in (name, start, new_lo, new_hi))
    return name, start.astype(np.int64), np.diff(np.append(start, n)).astype(np.int64), owner[start], lo.astype(np.int64), hi.astype(np.int64)


_POWERS: dict[int, np.ndarray] = {}
#: Odd multipliers of two independent span hashes, and their inverses modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)


def powers(base: int, n: int) -> np.ndarray:
    """base**k modulo 2**64 for k < n."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.empty(size, dtype=np.uint64)
        have[0] = 1
        done = 1
        while done < size:
            step = np.uint64(pow(base, done, 1 << 64))
            have[done : 2 * done] = have[:done] * step
            done *= 2
        _POWERS[base] = have
    return have[:n]


def prefix_sums(symbols: np.ndarray, which: int = 0) -> np.ndarray:
    """Prefix sums for ``span_hash``; ``which`` picks one of two hashes."""
    n = len(symbols)
    h = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mix(symbols.astype(np.uint64)) * powers(_BASES[which], n), out=h[1:])
    return h


def span_hash(h: np.ndarray, a: np.ndarray, b: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of the symbols [a, b): equal for equal strings wherever they stand."""
    return mix((h[b] - h[a]) * powers(_INVERSES[which], len(h))[a] + (b - a).astype(np.uint64))
