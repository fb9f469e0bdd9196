"""Range asymmetric numeral system with a static table, over numpy lanes.

A block is coded on its own: lane ``j`` of ``L`` holds the ids ``j, j + L, j + 2L, ...`` and has a 64-bit
state; all lanes move together, so one step is a few numpy operations. States stay in [2**31, 2**63) and
shed 32-bit words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
#: Magic, ids, lanes, checkpoints, words, crc32 of the ids.
HEAD = struct.Struct("<4sIIIII")
MAGIC = b"rns1"


class Table:
    """Frequencies scaled to ``2**bits``; every id that was counted keeps one at least."""

    def __init__(self, scaled: np.ndarray, bits: int):
        self.bits = bits
        self.freq = scaled.astype(np.uint64)
        self.first = np.concatenate([[0], np.cumsum(scaled)[:-1]]).astype(np.uint64)
        self._symbols: np.ndarray | None = None

    @classmethod
    def of(cls, counts: np.ndarray, bits: int = 20) -> Table:
        counts = np.asarray(counts, np.float64)
        seen = counts > 0
        if seen.sum() > 1 << bits:
            raise ValueError(f"{int(seen.sum())} ids do not fit 2**{bits} slots")
        if not seen.any():
            return cls(np.zeros(len(counts), np.int64), bits)
        spare = (1 << bits) - int(seen.sum())
        scaled = np.where(seen, 1 + np.floor(counts / counts.sum() * spare), 0).astype(np.int64)
        scaled[int(np.argmax(counts))] += (1 << bits) - int(scaled.sum())
        return cls(scaled, bits)

    @property
    def symbols(self) -> np.ndarray:
        """The id of each slot."""
        if self._symbols is None:
            kind = np.uint16 if len(self.freq) <= 1 << 16 else np.uint32
            self._symbols = np.repeat(np.arange(len(self.freq), dtype=kind), self.freq.astype(np.int64))
        return self._symbols

    def __getstate__(self):
        return {"bits": self.bits, "freq": self.freq, "first": self.first, "_symbols": None}


def encode(ids: np.ndarray, table: Table, lanes: int = 512, every: int = 256) -> bytes:
    """A block: header with counts and the ids' crc32, checkpoints, lane states, words, crc32 of what stands before.

    A checkpoint stands after each ``every`` steps and holds the step, the words read up to there and the
    states, so that ``decode`` can begin in the middle.
    """
    n = len(ids)
    lanes = max(1, min(lanes, n // 32))
    steps = -(-n // lanes)
    bits, shift = np.uint64(table.bits), np.uint64(63 - table.bits)
    state = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    marks: list[tuple[int, int, np.ndarray]] = []
    shed = 0
    for step in range(steps - 1, -1, -1):
        symbols = ids[step * lanes : (step + 1) * lanes]
        m = len(symbols)
        x, f = state[:m], table.freq[symbols]
        full = x >= (f << shift)
        if full.any():
            out = x[full].astype(np.uint32)
            words.append(out)
            shed += len(out)
            x = np.where(full, x >> WORD, x)
        whole, rest = np.divmod(x, f)
        state[:m] = (whole << bits) + rest + table.first[symbols]
        if step and step % every == 0:
            marks.append((step, shed, state.copy()))
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    points = b"".join(
        struct.pack("<II", step, shed - after) + states.astype("<u8").tobytes() for step, after, states in reversed(marks)
    )
    raw = np.asarray(ids).astype("<u4").tobytes()
    body = HEAD.pack(MAGIC, n, lanes, len(marks), len(stream), zlib.crc32(raw))
    body += state.astype("<u8").tobytes() + points + stream.astype("<u4").tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


def decode(block: bytes, table: Table, from_checkpoint: int = 0, check: bool = True) -> np.ndarray:
    """The ids of a block, from a checkpoint on (0: all). A wrong checksum raises ValueError."""
    if check and zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("a block's checksum does not match")
    magic, n, lanes, marks, count, crc = HEAD.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a block")
    at = HEAD.size
    state = np.frombuffer(block, "<u8", lanes, at).astype(np.uint64)
    at += 8 * lanes
    size = 8 + 8 * lanes
    step = cursor = 0
    if from_checkpoint:
        here = at + size * (from_checkpoint - 1)
        step, cursor = struct.unpack_from("<II", block, here)
        state = np.frombuffer(block, "<u8", lanes, here + 8).astype(np.uint64)
    words = np.frombuffer(block, "<u4", count, at + size * marks).astype(np.uint64)
    first_id = step * lanes
    out = np.empty(max(0, n - first_id), np.uint32)
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    symbols = table.symbols
    for begin in range(first_id, n, lanes):
        m = min(lanes, n - begin)
        x = state[:m]
        slot = x & mask
        got = symbols[slot]
        out[begin - first_id : begin - first_id + m] = got
        x = table.freq[got] * (x >> bits) + slot - table.first[got]
        empty = np.flatnonzero(x < LOW)
        k = len(empty)
        if k:
            x[empty] = (x[empty] << WORD) | words[cursor : cursor + k]
            cursor += k
        state[:m] = x
    if check and not from_checkpoint and zlib.crc32(out.astype("<u4").tobytes()) != crc:
        raise ValueError("the ids' checksum does not match")
    return out
