"""Minimal acyclic transducers from terms to their places in the order of bytes, walked for many words at once."""

from __future__ import annotations

import io
from collections.abc import Iterable
from dataclasses import dataclass, fields

import numpy as np

#: The number of each byte that a term may hold: a-z and all bytes of characters beyond ASCII. Others have none.
N_CLASSES = 26 + 128
CLASSES = np.full(256, -1, np.int64)
CLASSES[ord("a") : ord("z") + 1] = np.arange(26)
CLASSES[128:] = 26 + np.arange(128)
#: As CLASSES, with A-Z as a-z.
FOLDED = CLASSES.copy()
FOLDED[ord("A") : ord("Z") + 1] = np.arange(26)
#: Which edges a state has, 64 bits a word.
WORDS = -(-N_CLASSES // 64)


class Builder:
    """Takes terms in rising order and keeps one state for all states with equal futures."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.states: list[tuple] = []  # final, ((byte class, state), ...)
        self.ways: list[int] = []  # how many terms end behind each state
        self.path: list[list] = [[False, []]]  # of the last term: final, edges that are settled
        self.last: list[int] = []
        self.n = 0

    def add(self, term: bytes) -> None:
        classes = CLASSES[np.frombuffer(term, np.uint8)].tolist()
        if not classes or min(classes) < 0:
            raise ValueError(f"not a term: {term!r}")
        if self.n and classes <= self.last:
            raise ValueError(f"{term!r} is not behind the term before it")
        shared = 0
        for a, b in zip(classes, self.last, strict=False):
            if a != b:
                break
            shared += 1
        self._settle(shared)
        self.path += [[False, []] for _ in classes[shared:]]
        self.path[-1][0] = True
        self.last = classes
        self.n += 1

    def _settle(self, depth: int) -> None:
        """Turn what the path holds below ``depth`` into states."""
        while len(self.path) > depth + 1:
            final, edges = self.path.pop()
            self.path[-1][1].append((self.last[len(self.path) - 1], self._state(final, tuple(edges))))

    def _state(self, final: bool, edges: tuple) -> int:
        found = self.known.get((final, edges))
        if found is None:
            found = self.known[final, edges] = len(self.states)
            self.states.append((final, edges))
            self.ways.append(final + sum(self.ways[state] for _, state in edges))
        return found

    def done(self) -> Transducer:
        self._settle(0)
        final, edges = self.path[0]
        root = self._state(final, tuple(edges))
        bits = np.zeros((len(self.states), WORDS), np.uint64)
        first = np.zeros((len(self.states), WORDS), np.int32)
        target: list[int] = []
        skipped: list[int] = []
        for state, (ends, out) in enumerate(self.states):
            before, at = int(ends), 0
            for word in range(WORDS):
                first[state, word] = len(target)
                while at < len(out) and out[at][0] >> 6 == word:
                    c, to = out[at]
                    bits[state, word] |= np.uint64(1 << (c & 63))
                    target.append(to)
                    skipped.append(before)
                    before += self.ways[to]
                    at += 1
        return Transducer(
            bits.ravel(),
            first.ravel(),
            np.array(target, np.int32),
            np.array(skipped, np.int32),
            np.array([ends for ends, _ in self.states], bool),
            np.array([root], np.int32),
        )


@dataclass
class Transducer:
    """One or more transducers in flat arrays.

    The edges of a state lie together in the order of their bytes; a bit for each byte says which there are, and
    counting the bits below one gives its edge. An edge carries how many terms lie before those behind it.
    """

    bits: np.ndarray
    first: np.ndarray
    target: np.ndarray
    skipped: np.ndarray
    final: np.ndarray
    roots: np.ndarray

    def packed(self) -> bytes:
        held = io.BytesIO()
        np.savez(held, **{f.name: getattr(self, f.name) for f in fields(self)})
        return held.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Transducer:
        with np.load(io.BytesIO(data)) as held:
            return cls(**{f.name: held[f.name] for f in fields(cls)})

    @classmethod
    def joined(cls, parts: list[Transducer]) -> Transducer:
        """All parts in one set of arrays; the root of each stays its own."""
        states = np.cumsum([0, *(len(p.final) for p in parts)])[:-1]
        edges = np.cumsum([0, *(len(p.target) for p in parts)])[:-1]
        return cls(
            np.concatenate([p.bits for p in parts]),
            np.concatenate([p.first + e for p, e in zip(parts, edges, strict=True)]).astype(np.int32),
            np.concatenate([p.target + s for p, s in zip(parts, states, strict=True)]).astype(np.int32),
            np.concatenate([p.skipped for p in parts]),
            np.concatenate([p.final for p in parts]),
            np.concatenate([p.roots + s for p, s in zip(parts, states, strict=True)]).astype(np.int32),
        )

    def places(self, classes: np.ndarray, starts: np.ndarray, roots: np.ndarray) -> np.ndarray:
        """For words that begin at ``starts`` of the byte classes and end before a -1: the place of each among the
        terms of the transducer whose root it is given, or -1. All words take a step at a time."""
        found = np.full(len(starts), -1, np.int64)
        word, at = np.arange(len(starts)), starts.astype(np.int64)
        state, place = roots.astype(np.int64), np.zeros(len(starts), np.int64)
        while len(word):
            c = classes[at]
            ended = c < 0
            if ended.any():
                accepted = ended & self.final[state]
                found[word[accepted]] = place[accepted]
                word, at, state, place, c = (x[~ended] for x in (word, at, state, place, c))
            slot = state * WORDS + (c >> 6)
            bit = np.uint64(1) << (c & 63).astype(np.uint64)
            bits = self.bits[slot]
            goes = (bits & bit) != 0
            word, at, place, slot, bits, bit = (x[goes] for x in (word, at, place, slot, bits, bit))
            edge = self.first[slot] + np.bitwise_count(bits & (bit - np.uint64(1)))
            state = self.target[edge].astype(np.int64)
            place = place + self.skipped[edge]
            at = at + 1
        return found


def built(terms: Iterable[bytes]) -> Transducer:
    """The transducer of terms in rising order of their bytes."""
    builder = Builder()
    for term in terms:
        builder.add(term)
    return builder.done()
