"""Words of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

import numpy as np

#: Odd, so that it has an inverse modulo 2**64.
ODD = 0x9E3779B97F4A7C15
#: A prime, and a base for it. A polynomial modulo 2**64 alone gives some different words the same hash with any
#: base and whatever the codes of their letters are, so hashes take in one modulo a prime.
PRIME, BASE = (1 << 31) - 1, 1_583_458_089


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of a base and of its inverse, as many as were asked for so far."""

    def __init__(self, base: int, modulus: int):
        self.modulus, self.bases = modulus, (base, pow(base, -1, modulus))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (self._powers(base, 1 << (n - 1).bit_length()) for base in self.bases)
        return self.up, self.down

    def _powers(self, base: int, size: int) -> np.ndarray:
        found = np.ones(1, np.uint64)
        while len(found) < size:
            more = found * np.uint64(pow(base, len(found), self.modulus))
            found = np.concatenate([found, more % np.uint64(self.modulus) if self.modulus < 1 << 64 else more])
        return found


WIDE, PRIMED = Powers(ODD, 1 << 64), Powers(BASE, PRIME)


def stretch_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each stretch of 64-bit codes, the same wherever the stretch stands."""
    n = len(codes)
    sums = np.zeros(n + 1, np.uint64)
    up, down = WIDE.upto(n + 1)
    np.cumsum(codes * up[:n], out=sums[1:])
    wide = (sums[ends] - sums[starts]) * down[starts]
    up, down = PRIMED.upto(n + 1)
    own = codes >> np.uint64(33)
    own *= up[:n]
    # below 2**32 and the same modulo the prime, which is one less than 2**31
    high = own >> np.uint64(31)
    own &= np.uint64(PRIME)
    own += high
    np.cumsum(own, out=sums[1:])
    prime = np.uint64(PRIME)
    primed = (sums[ends] - sums[starts]) % prime * down[starts] % prime
    return mixed(wide + mixed(primed << np.uint64(32) | (ends - starts).astype(np.uint64) & np.uint64(0xFFFFFFFF)))


_BYTES = np.arange(256, dtype=np.uint64)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + np.uint64(32), _BYTES)
#: The code of each byte, A-Z as a-z.
CODES = mixed(_LOWER + np.uint64(1))
#: Whether a byte stands between words.
BLANK = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, A-Z lower-cased, and where each text's begin, with the end as the last entry."""
    raw = [text.encode("utf-8", "surrogatepass") for text in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    blank = BLANK[data]
    change = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(blank) and not blank[0]:
        change = np.concatenate([[0], change])
    starts, ends = change[0::2], change[1::2]
    sizes = np.array([len(x) + 1 for x in raw], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    return stretch_hashes(CODES[data], starts, ends), np.searchsorted(starts, begins)


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """The distinct hashes of ``size`` words in a row, sorted; fewer words are one shingle, none give none."""
    n = len(hashes)
    if not n:
        return hashes
    weights = mixed(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(ODD))
    if n < size:
        return mixed(np.array([(hashes * weights[:n]).sum() + np.uint64(n)], np.uint64))
    total = np.full(n - size + 1, np.uint64(size))
    for k in range(size):
        total += hashes[k : n - size + 1 + k] * weights[k]
    return np.unique(mixed(total))
