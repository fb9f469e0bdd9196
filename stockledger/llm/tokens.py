"""Token ids of many whole texts at once from a ``tokenizers`` file, packed as bytes."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

from stockledger.llm.words import mixed, stretch_hashes

#: The most stretches and ids that are remembered: some 100 MB for each Python worker.
REMEMBERED, REMEMBERED_IDS = 3_000_000, 16_000_000
#: Stretches that go to the tokenizer in one call.
CALL = 4096

_BYTES = np.arange(256, dtype=np.uint64)
CODES = mixed(_BYTES + np.uint64(0x1000))
CHECKS = mixed(_BYTES + np.uint64(0x2000))
BLANK = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
BLANKS = frozenset(np.flatnonzero(BLANK).tolist())
LETTER = ((_BYTES | np.uint64(32)) >= 97) & ((_BYTES | np.uint64(32)) <= 122)
MARK = np.isin(_BYTES, np.frombuffer(b".,;:!?", np.uint8))
#: White space that is more than one byte, or that libraries don't agree on.
OTHER_BLANKS = re.compile("[\x1c-\x1f\x85\xa0  -     　]")


def stretches(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where a byte-level pre-tokenizer surely begins another word, the texts' ``begins`` among them.

    A word ends where white space begins, where a mark follows an ASCII letter, and before and behind a
    line feed that stands alone. So the ids of a text are those of its stretches, one after the other.
    """
    blank = BLANK[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = (blank[1:] & ~blank[:-1]) | (MARK[data[1:]] & LETTER[data[:-1]])
    alone = np.flatnonzero((data[1:-1] == 10) & ~blank[:-2] & ~blank[2:]) + 2
    cut[alone] = True
    cut[begins[begins < len(data)]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Encodes texts with a tokenizer of the ``tokenizers`` library as its plain call does, with nothing added.

    With a plain byte-level pre-tokenizer texts are cut into ``stretches``. Words repeat, so each distinct one
    goes to the tokenizer once, and its ids are remembered under a hash of 64 bits, with a check of 32 bits that is
    made in another way and compared for every stretch; the ids of the texts are put together from there in numpy. Other pre-tokenizers, texts with rare white space and texts that hold an
    added token's string, such as a special token's, go there whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        decoder = self.tokenizer.get_added_tokens_decoder()
        self.added = [token.content for token in decoder.values() if token.content]
        # stretches are joined by line feeds
        joinable = len(feed) == 1 and not any("\n" in content for content in self.added)
        self.cuttable = _cuttable(json.loads(self.tokenizer.to_str())) and joinable
        self.feed = feed[0] if feed else 0
        self._forget()

    def _forget(self) -> None:
        # stretches by hash: hash, check, place of the ids in the pool, their number; large levels first
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.pool, self.used = np.zeros(1 << 16, self.dtype), 0

    def encode(self, texts: list[str], end: int | None = None) -> list[bytes]:
        """The ids of each text, and ``end`` behind them, as little-endian integers of ``self.dtype``."""
        last = b"" if end is None else np.array([end], self.dtype).tobytes()
        found: list[bytes] = [b""] * len(texts)
        cut = []
        for k, text in enumerate(texts):
            if self.cuttable and not OTHER_BLANKS.search(text) and not any(content in text for content in self.added):
                cut.append(k)
            else:
                found[k] = self._packed(text) + last
        ids, ends = self._together([texts[k].encode("utf-8", "surrogatepass") for k in cut])
        raw, size, before = ids.tobytes(), self.dtype.itemsize, 0
        for k, stop in zip(cut, ends.tolist()):
            found[k] = raw[size * before : size * stop] + last
            before = stop
        return found

    def _packed(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _together(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's end."""
        whole = b"".join(raw)
        data = np.frombuffer(whole, np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        if not len(data):
            return np.zeros(0, self.dtype), np.zeros(len(raw), np.int64)
        starts = stretches(data, bounds[:-1])
        ends = np.append(starts[1:], len(data))
        hashes = stretch_hashes(CODES[data], starts, ends)
        distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(CHECKS[data])])
        checks = (mixed(sums[ends] - sums[starts]) >> np.uint64(32)).astype(np.uint32)
        own = checks[first]
        if (checks != own[place]).any():  # two stretches with one hash
            parts = [np.frombuffer(self._packed(x.decode("utf-8", "surrogatepass")), self.dtype) for x in raw]
            return np.concatenate(parts), np.cumsum([len(x) for x in parts])
        places, counts, known = self._look_up(distinct, own)
        if not known.all():
            if sum(len(level[0]) for level in self.levels) > REMEMBERED or self.used > REMEMBERED_IDS:
                self._forget()
                known[:] = False
            new = np.flatnonzero(~known)
            some = first[new]
            parts = [whole[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist())]
            self._learn(distinct[new], own[new], parts)
            places, counts, _ = self._look_up(distinct, own)
        sizes = counts[place]
        stops = np.cumsum(sizes)
        total = int(stops[-1])
        source = np.repeat(places[place] - (stops - sizes), sizes) + np.arange(total)
        before = np.concatenate([[0], stops])
        return self.pool[source], before[np.searchsorted(starts, bounds[1:])]

    def _look_up(self, hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each stretch lie, how many they are, and whether it is remembered."""
        places, sizes = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        known = np.zeros(len(hashes), bool)
        for keys, marks, there, counts in self.levels:
            at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            hit = (keys[at] == hashes) & (marks[at] == checks)
            places[hit], sizes[hit] = there[at[hit]], counts[at[hit]]
            known |= hit
        return places, sizes, known

    def _learn(self, hashes: np.ndarray, checks: np.ndarray, parts: list[bytes]) -> None:
        """Remembers new stretches, in rising order of their hashes.

        They make a level of their own; a level joins the one before it unless that is four times as large, so
        what is remembered is copied a few times only.
        """
        ids, places, sizes = self._ids(parts)
        size = len(self.pool)
        while self.used + len(ids) > size:
            size *= 2
        if size > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(size - self.used, self.dtype)])
        self.pool[self.used : self.used + len(ids)] = ids
        level = (hashes, checks, places + self.used, sizes.astype(np.int32))
        self.used += len(ids)
        while self.levels and len(self.levels[-1][0]) < 4 * len(level[0]):
            level = _joined(self.levels.pop(), level)
        self.levels.append(level)

    def _ids(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each stretch's begin there and how many; most from calls with line feeds between."""
        sizes = np.zeros(len(parts), np.int64)
        plain = np.array([b"\n" not in part and part[-1] not in BLANKS for part in parts], bool)
        order = np.flatnonzero(plain)
        found = []
        for at in range(0, len(order), CALL):
            some = order[at : at + CALL]
            joined = b"\n".join([parts[k] for k in some.tolist()]).decode("utf-8", "surrogatepass")
            ids = np.array(self.tokenizer.encode(joined, add_special_tokens=False).ids, self.dtype)
            feeds = np.flatnonzero(ids == self.feed)
            if len(feeds) != len(some) - 1:
                raise ValueError("the tokenizer does not keep a line feed apart")
            sizes[some] = np.diff(np.concatenate([[-1], feeds, [len(ids)]])) - 1
            found.append(ids[ids != self.feed])
        rest = np.flatnonzero(~plain)
        for k in rest.tolist():
            found.append(np.frombuffer(self._packed(parts[k].decode("utf-8", "surrogatepass")), self.dtype))
            sizes[k] = len(found[-1])
        order = np.concatenate([order, rest])
        ids = np.concatenate(found) if found else np.zeros(0, self.dtype)
        places = np.zeros(len(parts), np.int64)
        places[order] = np.cumsum(sizes[order]) - sizes[order]
        return ids, places, sizes


def _joined(old: tuple[np.ndarray, ...], new: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Two levels as one; a hash that both have, with different checks, keeps the new entry."""
    at = np.minimum(np.searchsorted(new[0], old[0]), len(new[0]) - 1)
    stays = new[0][at] != old[0]
    both = [np.concatenate([a[stays], b]) for a, b in zip(old, new, strict=True)]
    order = np.argsort(both[0], kind="stable")
    return tuple(column[order] for column in both)


def _cuttable(described: dict) -> bool:
    before = described.get("pre_tokenizer") or {}
    return (
        described.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("add_prefix_space") is False
        and before.get("use_regex", True)
    )


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and file."""
    return Encoder(path)
