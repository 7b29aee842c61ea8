"""Wavelet matrix: a sequence of numbers as bit-planes with rank and select.

Plane l holds one bit of every number, from the most significant down. After each plane the sequence is split
stably, numbers with a 0 first. ``access``, ``rank``, ``select`` and ``decode`` work on arrays of positions at once.
Numbers are stored as their rank in the sorted list of numbers that occur, so there are only as many planes as that
list needs.
"""

from __future__ import annotations

import numpy as np


class BitPlane:
    """Bits with a count directory over 64-bit words."""

    def __init__(self, packed: np.ndarray, n: int):
        words = np.zeros((n + 63) // 64 + 1, np.uint64)
        words.view(np.uint8)[:len(packed)] = packed
        self.words, self.n = words, n
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        self.zeros = n - int(self.before[-1])

    def get(self, pos):
        return (self.words[pos >> 6] >> (pos & 63).astype(np.uint64)) & np.uint64(1)

    def rank1(self, pos):
        """Ones before each position (0 <= pos <= n)."""
        low = (np.uint64(1) << (pos & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[pos >> 6] + np.bitwise_count(self.words[pos >> 6] & low)

    def _select(self, k, ones: bool):
        width = np.arange(len(self.before), dtype=np.int64) * 64
        counts = self.before if ones else width - self.before
        word = np.searchsorted(counts, k, side="right") - 1
        bits = np.unpackbits(self.words[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        if not ones:
            bits = 1 - bits
        inside = np.cumsum(bits, axis=1, dtype=np.int64)
        return word * 64 + np.argmax(inside > (k - counts[word])[:, None], axis=1)

    def select1(self, k):
        """Position of the k-th one (from 0)."""
        return self._select(k, True)

    def select0(self, k):
        return self._select(k, False)


class WaveletMatrix:
    def __init__(self, alphabet: np.ndarray, planes: list[np.ndarray], n: int):
        self.alphabet, self.n, self.levels = alphabet, n, len(planes)
        self.planes = [BitPlane(p, n) for p in planes]

    # ---- building and stored form

    @staticmethod
    def planes_of(codes: np.ndarray, sigma: int) -> list[np.ndarray]:
        """Packed bit-planes of numbers below ``sigma``."""
        levels = max(1, int(sigma - 1).bit_length())
        cur = codes.astype(np.uint16 if levels <= 16 else np.uint32)
        out = []
        for level in range(levels - 1, -1, -1):
            bits = (cur >> cur.dtype.type(level)) & cur.dtype.type(1) != 0
            out.append(np.packbits(bits, bitorder="little"))
            if level:
                cur = np.concatenate([cur[~bits], cur[bits]])
        return out

    @classmethod
    def build(cls, numbers: np.ndarray) -> WaveletMatrix:
        alphabet, codes = np.unique(numbers, return_inverse=True)
        return cls(alphabet, cls.planes_of(codes, len(alphabet)), len(numbers))

    @classmethod
    def load(cls, alphabet: bytes, planes: bytes, n: int) -> WaveletMatrix:
        symbols = np.frombuffer(alphabet, np.uint32)
        size = (n + 7) // 8
        raw = np.frombuffer(planes, np.uint8)
        return cls(symbols, [raw[i:i + size] for i in range(0, len(raw), size)] if size else [], n)

    # ---- queries on positions

    def access(self, pos) -> np.ndarray:
        """Numbers at the positions."""
        pos = np.asarray(pos, np.int64)
        code = np.zeros(len(pos), np.int64)
        for plane in self.planes:
            bit = plane.get(pos).astype(bool)
            ones = plane.rank1(pos)
            pos = np.where(bit, plane.zeros + ones, pos - ones)
            code = code << 1 | bit
        return self.alphabet[code]

    def rank_code(self, code, pos) -> np.ndarray:
        """Occurrences of alphabet entry ``code`` before ``pos`` (arrays of one length)."""
        code, pos = np.asarray(code, np.int64), np.asarray(pos, np.int64)
        start = np.zeros_like(pos)
        for k, plane in enumerate(self.planes):
            bit = (code >> (self.levels - 1 - k) & 1).astype(bool)
            a, b = plane.rank1(start), plane.rank1(pos)
            start = np.where(bit, plane.zeros + a, start - a)
            pos = np.where(bit, plane.zeros + b, pos - b)
        return pos - start

    def code_of(self, number) -> tuple[np.ndarray, np.ndarray]:
        """(code, found) of numbers."""
        number = np.atleast_1d(np.asarray(number)).astype(self.alphabet.dtype)
        code = np.searchsorted(self.alphabet, number)
        code = np.minimum(code, max(0, len(self.alphabet) - 1))
        return code, (self.alphabet[code] == number if len(self.alphabet) else np.zeros(len(number), bool))

    def count(self, number) -> int:
        code, found = self.code_of(number)
        return int(self.rank_code(code, np.full(1, self.n))[0]) if found[0] else 0

    def occurrences(self, number) -> np.ndarray:
        """All positions of a number, ascending: select, walked up from the last plane."""
        code, found = self.code_of(number)
        if not found[0]:
            return np.zeros(0, np.int64)
        start = np.zeros(1, np.int64)
        stop = np.full(1, self.n, np.int64)
        for k, plane in enumerate(self.planes):
            bit = bool(code[0] >> (self.levels - 1 - k) & 1)
            a, b = plane.rank1(start), plane.rank1(stop)
            start, stop = (plane.zeros + a, plane.zeros + b) if bit else (start - a, stop - b)
        pos = np.arange(start[0], stop[0])
        for k in range(self.levels - 1, -1, -1):
            plane = self.planes[k]
            bit = bool(code[0] >> (self.levels - 1 - k) & 1)
            pos = plane.select1(pos - plane.zeros) if bit else plane.select0(pos)
        return pos

    def decode(self) -> np.ndarray:
        """The whole sequence, merged back from the last plane to the first."""
        dtype = np.uint16 if self.levels <= 16 else np.uint32
        code = np.zeros(self.n, dtype)
        for k in range(self.levels - 1, -1, -1):
            plane = self.planes[k]
            bits = np.unpackbits(plane.words.view(np.uint8), count=self.n, bitorder="little").view(bool)
            up = np.empty_like(code)
            up[~bits] = code[:plane.zeros]
            up[bits] = code[plane.zeros:] | dtype(1 << (self.levels - 1 - k))
            code = up
        return self.alphabet[code] if self.n else np.zeros(0, self.alphabet.dtype)
