"""Hashed word n-grams of texts, for the Jaccard join."""

from __future__ import annotations

import numpy as np
import xxhash

_U = np.uint64
#: Odd multipliers for the words of an n-gram by place; fixed values.
_PLACES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
_MOST_WORDS = 200_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ x >> _U(30)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ x >> _U(27)) * _U(0x94D049BB133111EB)
    return x ^ x >> _U(31)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _MOST_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


def shingles(texts: list[str | None], size: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams of ``size`` words of each text as 64-bit hashes: (all hashes, where each text's begin and end).

    Words are runs of anything but ASCII white space, A-Z in lower case. A text with fewer words is one n-gram of all of
    them, told apart by its length; without words there is none. The hashes of a text are sorted.
    """
    words = [t.encode().lower().split() if t else [] for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    hashed = np.concatenate([np.fromiter(map(_words.__getitem__, w), np.uint64, len(w)) for w in words] + [np.zeros(size, np.uint64)])
    begin = np.cumsum(counts) - counts
    # a short text is padded, by a mask, to one n-gram of its own words
    gram = np.full(len(hashed) - size, size, np.uint64)
    for i in range(size):
        gram = mix(gram + hashed[i:len(hashed) - size + i] * _U(_PLACES[i]))
    for d in np.flatnonzero((counts > 0) & (counts < size)):
        own = _U(counts[d])
        for i in range(counts[d]):
            own = mix(np.array([own + hashed[begin[d] + i] * _U(_PLACES[i])], np.uint64))[0]
        gram[begin[d]] = own
    sizes = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    gram = gram.view(np.int64)
    parts = [np.sort(gram[b:b + n]) for b, n in zip(begin.tolist(), sizes.tolist())]
    ends = np.cumsum(sizes)
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[(ends - sizes)[sizes > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return flat[new], kept[np.concatenate([[0], ends]).astype(np.int64)]
