"""FM-index over word codes: backward search, occurrence lookup by sampled suffix positions.

The text is a sequence of codes; 0 is a separator that no pattern contains. Every separator counts as a symbol of its
own, ordered by place, so comparing two suffixes ends at the first separator.
"""

from __future__ import annotations

import numpy as np

from duotower.llm.wavelet import BitPlane, WaveletMatrix

SAMPLE = 16     # every so many places of a run of words the suffix position is kept


def run_start(codes: np.ndarray) -> np.ndarray:
    """Place where the run of each position begins (the place after the last separator before it)."""
    at = np.arange(len(codes))
    first = np.concatenate([[0], np.where(codes[:-1] == 0, at[1:], 0)]) if len(codes) else at
    return np.maximum.accumulate(first)


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Sorted suffixes; the sequence ends with a separator. Prefix doubling that re-sorts only tied suffixes."""
    n = len(codes)
    bits = max(1, int(codes.max()).bit_length())
    h = max(1, 63 // bits)
    at = np.arange(n)
    ends = np.flatnonzero(codes == 0)
    run = ends[np.searchsorted(ends, at)] - at      # words before the next separator
    key = np.zeros(n, np.uint64)
    for k in range(h):
        # nothing counts beyond the separator
        col = np.zeros(n, np.uint64)
        if k < n:
            col[:n - k] = codes[k:]
        col[run < k] = 0
        key = key << np.uint64(bits) | col
    sa = np.argsort(key)
    ordered = key[sa]
    group = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
    packed = group.astype(np.uint64) << np.uint64(32) | sa.astype(np.uint64)
    packed.sort()
    sa = (packed & np.uint64(0xFFFFFFFF)).astype(np.int64)
    group = (packed >> np.uint64(32)).astype(np.int64)
    # rank of a suffix: where its tie group begins; a suffix that ended within h words is settled by its place
    head = np.concatenate([[True], (group[1:] != group[:-1]) | (run[sa[1:]] < h)])
    start = np.maximum.accumulate(np.where(head, at, 0))
    rank = np.empty(n, np.int64)
    rank[sa] = start
    while True:
        tied = np.flatnonzero(~head | np.concatenate([~head[1:], [False]]))
        if not len(tied):
            return sa
        suffix = sa[tied]
        own, nxt = rank[suffix], rank[suffix + h]
        order = np.lexsort((suffix, nxt, own))
        suffix, own, nxt = suffix[order], own[order], nxt[order]
        sa[tied] = suffix       # groups keep their slots, as ``tied`` is ascending
        fresh = np.concatenate([[True], (own[1:] != own[:-1]) | (nxt[1:] != nxt[:-1]) | (run[suffix[1:]] < 2 * h)])
        head[tied] = fresh
        start = np.maximum.accumulate(np.where(head, at, 0))
        rank[suffix] = start[tied]
        h *= 2


class FmIndex:
    """Stored parts: ``alphabet`` (codes that occur, uint32), ``planes`` of the Burrows-Wheeler sequence, ``marked`` (bit per
    suffix whose position is kept) and ``samples`` (those positions, int32), each as bytes."""

    def __init__(self, n: int, alphabet: bytes, planes: bytes, marked: bytes, samples: bytes):
        self.n = n
        self.bwt = WaveletMatrix.load(alphabet, planes, n)
        self.marked = BitPlane(np.frombuffer(marked, np.uint8), n)
        self.samples = np.frombuffer(samples, np.int32)
        k = len(self.bwt.alphabet)
        # where each symbol's stretch begins: in the sorted suffixes, and below the last plane
        counts, self.bottom = self._stretches(np.arange(k))
        self.first = np.cumsum(counts) - counts

    @staticmethod
    def parts(codes: np.ndarray) -> dict:
        sa = suffix_array(codes)
        alphabet = np.flatnonzero(np.bincount(codes)).astype(np.uint32)
        dense = np.zeros(int(alphabet[-1]) + 1, np.uint32)
        dense[alphabet] = np.arange(len(alphabet))
        planes = WaveletMatrix.planes_of(dense[codes[sa - 1]], len(alphabet))
        keep = ((np.arange(len(codes)) - run_start(codes)) % SAMPLE == 0)[sa]
        return {"n": len(codes), "alphabet": alphabet.tobytes(), "planes": np.concatenate(planes).tobytes(),
                "marked": np.packbits(keep, bitorder="little").tobytes(), "samples": sa[keep].astype(np.int32).tobytes()}

    def _stretches(self, code):
        start, stop = np.zeros(len(code), np.int64), np.full(len(code), self.n, np.int64)
        for k, plane in enumerate(self.bwt.planes):
            bit = (code >> (self.bwt.levels - 1 - k) & 1).astype(bool)
            a, b = plane.rank1(start), plane.rank1(stop)
            start, stop = np.where(bit, plane.zeros + a, start - a), np.where(bit, plane.zeros + b, stop - b)
        return stop - start, start

    def _step(self, code, row):
        """Rows of the suffixes one symbol ``code`` longer."""
        for k, plane in enumerate(self.bwt.planes):
            bit = (code >> (self.bwt.levels - 1 - k) & 1).astype(bool)
            ones = plane.rank1(row)
            row = np.where(bit, plane.zeros + ones, row - ones)
        return row

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of patterns; ``patterns`` is padded, the codes of row i are its first ``lengths[i]``."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for k in range(patterns.shape[1]):
            live = np.flatnonzero((lengths > k) & (lo < hi))
            if not len(live):
                break
            code, found = self.bwt.code_of(patterns[live, lengths[live] - 1 - k])
            hi[live[~found]] = lo[live[~found]]
            live, code = live[found], code[found]
            shift = self.first[code] - self.bottom[code]
            lo[live], hi[live] = shift + self._step(code, lo[live]), shift + self._step(code, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back until a kept position."""
        out, walked = np.zeros(len(rows), np.int64), 0
        todo, rows = np.arange(len(rows)), np.asarray(rows, np.int64)
        while len(todo):
            known = self.marked.get(rows).astype(bool)
            out[todo[known]] = self.samples[self.marked.rank1(rows[known])] + walked
            todo, rows = todo[~known], rows[~known]
            code = np.searchsorted(self.bwt.alphabet, self.bwt.access(rows))
            rows = self.first[code] - self.bottom[code] + self._step(code, rows)
            walked += 1
        return out
