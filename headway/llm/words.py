"""Words between white space, found and hashed by numpy: many at a time, without an object for each."""

from __future__ import annotations

import numpy as np
import xxhash

LONG = 256  # bytes; longer words are hashed one by one
_SPACE = np.isin(np.arange(256), list(b"\t\n\v\f\r "))
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # masks of so many bytes


def mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 63-bit hash of a pair of hashes, never 0."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.maximum((x ^ (x >> np.uint64(31))) >> np.uint64(1), np.uint64(1))


def whole(words, seed: int = 0) -> np.ndarray:
    """63-bit hashes of words of any length, never 0."""
    digest = (xxhash.xxh64_intdigest(word, seed) for word in words)
    return np.maximum(np.fromiter(digest, np.uint64) >> np.uint64(1), np.uint64(1))


class Words:
    """The words of texts between the six ASCII white-space characters: where they begin, their sizes, how many each text has."""

    def __init__(self, texts: list[bytes], lower: bool = False) -> None:
        raw = b" ".join([b"", *texts, b" " * 8])
        self.raw = raw.lower() if lower else raw
        codes = np.frombuffer(self.raw, np.uint8)
        solid = ~_SPACE[codes]
        edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
        self.begin, self.sizes = edges[::2], edges[1::2] - edges[::2]
        bounds = np.cumsum([1] + [len(text) + 1 for text in texts])
        self.per_text = np.diff(np.searchsorted(self.begin, bounds))
        self._eights = np.ndarray(len(codes) - 7, "<u8", codes, strides=(1,))  # the eight bytes from each byte on

    def hashes(self, seeds: tuple[int, ...] = (0,)) -> list[np.ndarray]:
        """63-bit hashes of all words, one array a seed."""
        out = [self.sizes.astype(np.uint64) + np.uint64(seed) for seed in seeds]
        live, done = np.flatnonzero(self.sizes <= LONG), 0
        while len(live):  # eight bytes more of each word
            left = self.sizes[live] - done
            piece = self._eights[self.begin[live] + done] & _FIRST[np.minimum(left, 8)]
            for hashes in out:
                hashes[live] = mix(hashes[live], piece)
            live, done = live[left > 8], done + 8
        long = np.flatnonzero(self.sizes > LONG)
        for hashes, seed in zip(out, seeds):
            hashes[long] = whole(self.bytes(long), seed)
        return out

    def bytes(self, which: np.ndarray) -> list[bytes]:
        begin = self.begin[which]
        return [self.raw[a:b] for a, b in zip(begin.tolist(), (begin + self.sizes[which]).tolist())]
