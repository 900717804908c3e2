"""Counting quotient filters over packed tuples of word ids, lossless.

A tuple of ``n`` ids of ``bits`` bits is packed into ``n * bits`` bits (128 at
most) and permuted by a Feistel network, which is invertible and spreads keys
evenly. The first ``skip`` bits of the permuted key are the filter's shard, the
next ``q`` its quotient, and all others its remainder, kept in full: keys never
collide and come back as tuples. Entries stand sorted by key. A bitmap tells
which quotients occur and one bit an entry which are the last of their run, so
remainders need no quotients beside them; a count of one costs one bit, a larger
one a byte, or nine. Filters of one shard merge by their order.

Keys are two arrays of 64-bit words, the first one filled from the top.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

_ROUNDS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)
_U = np.uint64
Keys = tuple[np.ndarray, np.ndarray]


def _mask(bits: int) -> np.uint64:
    return _U((1 << bits) - 1)


def _left(a: np.ndarray, by: int) -> np.ndarray:
    return a << _U(by) if by < 64 else np.zeros_like(a)


def _right(a: np.ndarray, by: int) -> np.ndarray:
    return a >> _U(by) if by < 64 else np.zeros_like(a)


def _mixed(a: np.ndarray, seed: int) -> np.ndarray:
    a = (a ^ _U(seed)) * _U(0xFF51AFD7ED558CCD)
    a = (a ^ (a >> _U(32))) * _U(0xC4CEB9FE1A85EC53)
    return a ^ (a >> _U(29))


def permuted(ids: list[np.ndarray], bits: int) -> Keys:
    """Keys of tuples, given as columns (uint64, two to four of them)."""
    n = len(ids)
    halves = [np.zeros(len(ids[0]), _U), np.zeros(len(ids[0]), _U)]
    widths = [(n + 1) // 2 * bits, n // 2 * bits]
    for j in range(n):
        h = j >= (n + 1) // 2
        halves[h] = _left(halves[h], bits) | ids[j]
    for i, seed in enumerate(_ROUNDS):
        halves[i % 2] = halves[i % 2] ^ (_mixed(halves[1 - i % 2], seed) & _mask(widths[i % 2]))
    (a, b), (wa, wb) = halves, widths
    spare = 64 - wa
    if wb <= spare:
        return _left(a, spare) | _left(b, spare - wb), np.zeros(len(a), _U)
    return (_left(a, spare) if spare else a) | _right(b, wb - spare), _left(b, 64 - (wb - spare))


def restored(keys: Keys, n: int, bits: int) -> np.ndarray:
    """The ids of permuted keys."""
    hi, lo = keys
    wa, wb = (n + 1) // 2 * bits, n // 2 * bits
    spare = 64 - wa
    a = _right(hi, spare)
    b = (_right(hi, spare - wb) if wb <= spare else _left(hi, wb - spare) | _right(lo, 64 - (wb - spare))) & _mask(wb)
    halves, widths = [a, b], [wa, wb]
    for i, seed in reversed(list(enumerate(_ROUNDS))):
        halves[i % 2] = halves[i % 2] ^ (_mixed(halves[1 - i % 2], seed) & _mask(widths[i % 2]))
    columns = []
    for half, k in ((halves[0], (n + 1) // 2), (halves[1], n // 2)):
        columns += [_right(half, (k - 1 - j) * bits) & _mask(bits) for j in range(k)]
    return np.stack(columns, axis=1)


def counted(keys: Keys, counts: np.ndarray | None = None) -> tuple[Keys, np.ndarray]:
    """Distinct keys in order, and the sums of their counts (each one if not given)."""
    hi, lo = keys
    if counts is None and not lo.any():
        hi = np.sort(hi)
        first = np.flatnonzero(np.append(True, hi[1:] != hi[:-1])[: len(hi)])
        return (hi[first], lo[: len(first)]), np.diff(np.append(first, len(hi)))
    counts = np.ones(len(hi), np.int64) if counts is None else counts
    order = np.lexsort((lo, hi)) if lo.any() else np.argsort(hi, kind="stable")
    hi, lo, counts = hi[order], lo[order], counts[order]
    if not len(hi):
        return (hi, lo), counts
    first = np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])]))
    return (hi[first], lo[first]), np.add.reduceat(counts, first)


def encoded(keys: Keys, counts: np.ndarray, total: int, skip: int) -> bytes:
    """A filter of sorted, distinct keys that agree in their first ``skip`` bits;
    ``total`` bits are in use."""
    hi, lo = keys
    m = len(hi)
    q = max(0, min(m.bit_length(), total - skip, 32, 63 - skip))
    runs = _right(_left(hi, skip), 64 - q)
    occupied = np.zeros(1 << q, bool)
    occupied[runs] = True
    last = np.append(runs[1:] != runs[:-1], True)
    by = skip + q
    rest = (total - by + 7) // 8
    words = np.stack([_left(hi, by) | _right(lo, 64 - by), _left(lo, by)], axis=1).astype(">u8")
    remainders = words.view(np.uint8).reshape(m, 16)[:, :rest]
    many = counts > 1
    more = counts[many]
    small = np.minimum(more, 255).astype(np.uint8)
    parts = [np.packbits(occupied), np.packbits(last), remainders, np.packbits(many), small, more[small == 255].astype("<i8")]
    return struct.pack("<qbb", m, q, skip) + b"".join(p.tobytes() for p in parts)


def decoded(body: bytes, total: int, shard: int) -> tuple[Keys, np.ndarray]:
    """Keys, in order, and counts of a filter of ``shard``."""
    m, q, skip = struct.unpack_from("<qbb", body)
    at = 10

    def take(n: int, kind="u1") -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, kind, n, at)
        at += out.nbytes
        return out

    occupied = np.flatnonzero(np.unpackbits(take((1 << q) + 7 >> 3), count=1 << q)).astype(_U)
    last = np.unpackbits(take(m + 7 >> 3), count=m).astype(bool)
    by = skip + q
    rest = (total - by + 7) // 8
    words = np.zeros((m, 16), np.uint8)
    words[:, :rest] = take(m * rest).reshape(m, rest)
    words = words.view(">u8").astype(_U)
    many = np.unpackbits(take(m + 7 >> 3), count=m).astype(bool)
    counts = np.ones(m, np.int64)
    small = take(int(many.sum())).astype(np.int64)
    small[small == 255] = take(int((small == 255).sum()), "<i8")
    counts[many] = small
    runs = occupied[np.concatenate([[0], np.cumsum(last)[:-1]]).astype(np.int64)] if m else occupied
    top = np.full(m, shard, _U)
    hi = _left(top, 64 - skip) | _right(_left(runs, 64 - q), skip) | _right(words[:, 0], by)
    lo = (_left(words[:, 0], 64 - by) | _right(words[:, 1], by)) if by else words[:, 1].copy()
    return (hi, lo), counts


def merged(bodies: list[bytes], total: int, shard: int) -> tuple[Keys, np.ndarray]:
    """Entries of filters of one shard, equal keys added up."""
    parts = [decoded(b, total, shard) for b in bodies]
    return counted((np.concatenate([k[0] for k, _ in parts]), np.concatenate([k[1] for k, _ in parts])), np.concatenate([c for _, c in parts]))


def sharded(keys: Keys, counts: np.ndarray, total: int, skip: int) -> Iterator[tuple[int, bytes]]:
    """Filters of sorted entries by their first ``skip`` bits."""
    hi, lo = keys
    shards = _right(hi, 64 - skip)
    cuts = np.concatenate([[0], np.flatnonzero(shards[1:] != shards[:-1]) + 1, [len(hi)]]) if len(hi) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(shards[a]), encoded((hi[a:b], lo[a:b]), counts[a:b], total, skip)
