"""Words of texts and their shingles as sorted arrays of 64-bit codes; numpy inside tasks."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _ODD) | np.uint64(1)


_BYTES = _byte_values()


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, _ODD | np.uint64(1), np.uint64))


def segment_codes(data: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each stretch of bytes that ends where ``stops`` is true (its last byte included)."""
    ends = np.flatnonzero(stops)
    if not len(ends):
        return np.zeros(0, np.uint64)
    starts = np.concatenate([[0], ends[:-1] + 1])
    lengths = ends - starts + 1
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    return mix(np.add.reduceat(_BYTES[data] * _powers(int(lengths.max()))[place], starts))


class Words:
    """The words of several texts: ``code`` (64-bit hash of each word), ``doc`` (its text), ``counts`` (per text).

    Texts are UTF-8 bytes; A-Z are lower-cased, words are runs of anything but ASCII white space.
    """

    def __init__(self, texts: list[bytes | None]):
        # bytes.split and bytes.lower know ASCII white space and letters only, as the contract wants
        parts = [t.lower().split() if t else [] for t in texts]
        self.counts = np.array([len(p) for p in parts], np.int64)
        self.doc = np.repeat(np.arange(len(parts)), self.counts)
        flat = b" ".join(w for p in parts for w in p) + b" "
        data = np.frombuffer(flat, np.uint8)
        self.code = segment_codes(data, data == 32) if self.counts.sum() else np.zeros(0, np.uint64)

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(code, doc) of every run of ``n`` words; a text with fewer words gives its whole sequence as one."""
        many = self.counts >= n
        first = np.cumsum(self.counts) - self.counts
        at = np.arange(len(self.code))
        begins = at[at - first[self.doc] <= (self.counts - n)[self.doc]] if len(at) else at
        code = np.zeros(len(begins), np.uint64)
        for k in range(n):
            code = mix(code * _ODD + self.code[begins + k] + np.uint64(k + 1))
        short = np.flatnonzero(~many & (self.counts > 0))
        extra = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            has = self.counts[short] > k
            step = mix(extra * _ODD + self.code[np.minimum(first[short] + k, len(self.code) - 1)] + np.uint64(1000 + k))
            extra = np.where(has, step, extra)
        return np.concatenate([code, extra]), np.concatenate([self.doc[begins], short])


def sorted_sets(code: np.ndarray, doc: np.ndarray, n_docs: int) -> list[np.ndarray]:
    """Each text's distinct codes, ascending."""
    order = np.lexsort((code, doc))
    code, doc = code[order], doc[order]
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
    code, doc = code[keep], doc[keep]
    return np.split(code, np.searchsorted(doc, np.arange(1, n_docs)))
