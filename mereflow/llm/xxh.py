"""XXH64 of many byte ranges at once."""

from __future__ import annotations

import numpy as np
import xxhash

_U = np.uint64
P1, P2, P3, P4, P5 = (_U(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
#: Longer ranges go one by one.
LONG = 128


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << _U(n)) | (x >> _U(64 - n))


def _round(acc, lane):
    return _rotl(acc + lane * P2, 31) * P1


def xxh64(data: bytes, start: np.ndarray, end: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of ``data[start[i]:end[i]]`` for every i, as uint64."""
    out, size, s = np.empty(len(start), _U), end - start, _U(seed)
    padded = data + bytes(8)
    words = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    halves = np.ndarray(len(data) + 5, "<u4", padded, strides=(1,))
    raw = np.frombuffer(padded, np.uint8)
    order = np.argsort(size, kind="stable")
    lengths, first = np.unique(size[order], return_index=True)
    with np.errstate(over="ignore"):
        for n, a, z in zip(lengths.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
            rows = order[a:z]
            at = start[rows]
            if n > LONG:
                out[rows] = [xxhash.xxh64_intdigest(data[i : i + n], seed) for i in at.tolist()]
                continue
            k = 0
            if n >= 32:
                v = [np.full(len(at), x, _U) for x in (s + P1 + P2, s + P2, s, s - P1)]
                while k + 32 <= n:
                    v = [_round(x, words[at + (k + 8 * i)]) for i, x in enumerate(v)]
                    k += 32
                h = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
                for x in v:
                    h = (h ^ _round(_U(0), x)) * P1 + P4
            else:
                h = np.full(len(at), s + P5, _U)
            h = h + _U(n)
            while k + 8 <= n:
                h = _rotl(h ^ _round(_U(0), words[at + k]), 27) * P1 + P4
                k += 8
            if k + 4 <= n:
                h = _rotl(h ^ (halves[at + k].astype(_U) * P1), 23) * P2 + P3
                k += 4
            while k < n:
                h = _rotl(h ^ (raw[at + k].astype(_U) * P5), 11) * P1
                k += 1
            h = (h ^ (h >> _U(33))) * P2
            h = (h ^ (h >> _U(29))) * P3
            out[rows] = h ^ (h >> _U(32))
    return out
