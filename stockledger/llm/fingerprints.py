"""Fingerprints of the phrases that a Lempel-Ziv parser finds in a text."""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.llm.layout import slices, tidy
from stockledger.llm.words import mixed, stretch_hashes

#: Minima in a fingerprint, each kept as 16 bits; documents in one range of ids, unless that gives more ranges.
MINIMA, RANGE_ROWS, RANGES = 128, 1000, 20_000
#: Characters hashed at once, so that they stay in the processor's cache; rows, and about the characters, of a group
#: of texts that is compared at once.
HASHED_CHARS, RESULT_ROWS, GROUP_CHARS = 1 << 15, 256, 1 << 21
RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def parse(text: str, begin: int, seen: set[str], until: int, ends: list[int]) -> int:
    """Parses ``text`` from ``begin`` into phrases, each a phrase of ``seen`` and one more character.

    New phrases go into ``seen``, where they end into ``ends``. Stops at the first phrase that ends behind
    ``until`` and returns where it begins; a rest that is all in ``seen`` is no phrase. Every phrase but its
    last character is in ``seen``, so the longest match is found by widening or narrowing the last length, by one
    character at first and further the longer it takes, and by halving what is left between.
    """
    n, size, add = len(text), 1, seen.add
    while begin < n:
        end = begin + size
        if end > n:
            end = n
        if text[begin:end] in seen:
            known = end
            end += 1
            while end <= n and text[begin:end] in seen:
                known = end
                end += 1 + (end - begin - size >> 2)
            if end > n:
                if known == n or text[begin:n] in seen:
                    return begin if until < n else n
                end = n
        else:
            known = end - 1
            while known > begin and text[begin:known] not in seen:
                end = known
                known -= 1 + (size - known + begin >> 2)
            if known < begin:
                known = begin
        while end - known > 1:
            middle = (known + end) // 2
            if text[begin:middle] in seen:
                known = middle
            else:
                end = middle
        if end > until:
            return begin
        add(text[begin:end])
        ends.append(end)
        size = end - begin
        begin = end
    return begin


#: Texts of more characters are parsed by slices: few look-ups of long phrases are faster there than many nodes of a
#: tree that the processor's cache can't hold.
TREE_CHARS = 1 << 17
#: Where characters end, as numbers that need not be made again for each text; a phrase that none goes on.
PLACES, LEAF = list(range(1, TREE_CHARS + 1)), {}


def grow(
    text: str, at: int, root: dict, state: tuple[dict, dict, str], ends: list[int], log: list | None = None
) -> tuple[dict, dict, str]:
    """Walks ``text``, which stands at ``at`` in one of TREE_CHARS, down a tree of phrases and adds a leaf where it ends.

    The phrases are those of ``parse``: each is one of the tree and one more character. A node is a dict from
    characters to nodes; nodes that nothing goes on from are all ``LEAF``, and made on their own once something does.
    ``state`` is the node the walk stands on, the one above and the character between; the new one is returned.
    Where phrases end goes into ``ends``, where leaves were added into ``log``.
    """
    node, above, last = state
    add = ends.append
    for c, end in zip(text, PLACES[at : at + len(text)]):
        if c in node:
            above = node
            last = c
            node = node[c]
        else:
            if node is LEAF:
                above[last] = {c: LEAF}
                if log is not None:
                    log.append((above, last))
            else:
                node[c] = LEAF
                if log is not None:
                    log.append((node, c))
            add(end)
            node = root
    return node, above, last


def both_phrases(text: str, half: int, edited: str) -> tuple[list[int], int, list[int], int]:
    """Parses a text and another that has the same first ``half`` characters, which are parsed once.

    Returns where the text's phrases end, how many of them both have, where the further ones of the edited text
    end, and where these begin.
    """
    ends: list[int] = []
    tail: list[int] = []
    if len(text) > TREE_CHARS:
        seen: set[str] = set()
        begin = parse(text, 0, seen, half, ends)
        both, other = len(ends), set(seen)
        parse(text, begin, seen, len(text), ends)
        parse(edited, begin, other, len(edited), tail)
        return ends, both, tail, begin
    root: dict = {}
    middle = grow(text[:half], 0, root, (root, root, ""), ends)
    both, log = len(ends), []
    grow(text[half:], half, root, middle, ends, log)
    for node, c in reversed(log):  # as it was at half
        if node[c] is LEAF:
            del node[c]
        else:
            node[c] = LEAF
    grow(edited[half:], half, root, middle, tail)
    return ends, both, tail, ends[both - 1] if both else 0


#: The code that each character is hashed as.
POINTS = mixed(np.arange(1, 0x110001, dtype=np.uint64))


def phrase_hashes(text: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of the text, the same wherever the stretch stands."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return stretch_hashes(POINTS.take(points), starts, ends)


def _hashed(pieces: Iterator[tuple[str, int, np.ndarray]]) -> np.ndarray:
    """The hashes of phrases that follow each other in texts: where they begin in each and where they end."""
    found: list[np.ndarray] = [np.zeros(0, np.uint64)]
    texts: list[str] = []
    starts: list[np.ndarray] = []
    ends: list[np.ndarray] = []
    chars = 0

    def hash_all() -> None:
        found.append(phrase_hashes("".join(texts), np.concatenate(starts), np.concatenate(ends)))
        texts.clear(), starts.clear(), ends.clear()

    for text, begin, stops in pieces:
        k = 0
        while k < len(stops):
            # long texts are cut where phrases end
            until = len(stops) if stops[-1] - begin <= HASHED_CHARS else max(k + 1, int(np.searchsorted(stops, begin + HASHED_CHARS)))
            own = stops[k:until] + (chars - begin)
            k, part = until, text[begin : stops[until - 1]]
            begin = int(stops[until - 1])
            texts.append(part)
            starts.append(np.concatenate([[chars], own[:-1]]))
            ends.append(own)
            chars += len(part)
            if chars >= HASHED_CHARS:
                hash_all()
                chars = 0
    if texts:
        hash_all()
    return np.concatenate(found)


NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _least(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A row of MINIMA bins for each of ``counts``, which say how many hashes in a row are its own: the smallest
    hash in each bin, without the bin; NONE where a bin has none."""
    bins = (hashes % np.uint64(MINIMA)).astype(np.int64)
    bins += np.repeat(np.arange(len(counts)) * MINIMA, counts)
    least = np.full(len(counts) * MINIMA, NONE)
    np.minimum.at(least, bins, hashes // np.uint64(MINIMA))
    return least.reshape(len(counts), MINIMA)


def _low(least: np.ndarray) -> np.ndarray:
    """The low 16 bits, never 0; 0 where a bin has none."""
    low = (least & np.uint64(0xFFFF)).astype(np.uint16)
    low[low == 0] = 1
    low[least == NONE] = 0
    return low


def minima(hashes: np.ndarray) -> np.ndarray:
    """The low 16 bits, never 0, of the smallest hash in each of MINIMA bins; 0 where a bin has none."""
    return _low(_least(hashes, np.array([len(hashes)])))[0]


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``likeness`` of each row of minima with the same row of others."""
    filled = np.count_nonzero((a != 0) | (b != 0), axis=1)
    same = np.count_nonzero((a == b) & (a != 0), axis=1)
    return np.where(filled > 0, same / np.maximum(filled, 1), 1.0)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal minima among the bins that either has filled; 1 for two without phrases."""
    return float(_alike(a[None], b[None])[0])


def written_as(values: np.ndarray) -> str:
    return base64.b64encode(values.astype("<u2").tobytes()).decode()


def read_from(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u2")


def fingerprint(text: str) -> np.ndarray:
    """The minima of a text's phrases."""
    ends: list[int] = []
    parse(text, 0, set(), len(text), ends)
    stops = np.array(ends, np.int64)
    return minima(phrase_hashes(text, np.concatenate([[0], stops[:-1]]).astype(np.int64), stops) if ends else np.zeros(0, np.uint64))


def both_fingerprints(text: str, half: int, edited: str) -> tuple[np.ndarray, np.ndarray]:
    """The minima of a text and of another that has the same first ``half`` characters, which are parsed once."""
    own, other = _fingerprints([(text, half, edited)])
    return own[0], other[0]


def _fingerprints(pairs: list[tuple[str, int, str]]) -> tuple[np.ndarray, np.ndarray]:
    """A row of ``both_fingerprints`` for each text, count of its first characters and edited text."""
    counts: list[int] = []

    def pieces() -> Iterator[tuple[str, int, np.ndarray]]:
        for text, half, edited in pairs:
            ends, both, tail, begin = both_phrases(text, half, edited)
            counts.extend((both, len(ends) - both, len(tail)))
            yield text, 0, np.frombuffer(array("q", ends), np.int64)
            yield edited, begin, np.frombuffer(array("q", tail), np.int64)

    hashes = _hashed(pieces())
    least = _least(hashes, np.array(counts)).reshape(-1, 3, MINIMA)
    return _low(np.minimum(least[:, 0], least[:, 1])), _low(np.minimum(least[:, 0], least[:, 2]))


def _ranges(docs: DataFrame, rows_in_range: int) -> tuple[np.ndarray, np.ndarray, dict[int, tuple[int, int]]]:
    """Bounds that cut the rows into ranges of about equal counts, and the last row of each range that has any.

    Bounds and rows are an id and a turned tie, in two arrays and in pairs by the range's number. An id that takes
    several cuts has its ties, which are hashes, cut evenly. Ties are read only if there is such an id, else all
    are the least.
    """
    ids = docs.select(_order_id().alias("id"))
    n = ids.count()
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), {}
    parts = min(RANGES, -(-n // rows_in_range))
    shares = [k / parts for k in range(1, parts)]
    cuts = ids.agg(F.percentile_approx("id", shares, 10 * parts)).first()[0] if shares else []
    bounds, times = np.unique(np.array(cuts, np.int64), return_counts=True)
    turned = [k * (1 << 64) // m - (1 << 63) for m in times.tolist() for k in range(m)]
    bounds, turned = np.repeat(bounds, times), np.array(turned, np.int64)
    tied = bool((times > 1).any())
    rows = docs.select(_order_id().alias("id"), (F.bitwise_not(_tie()) if tied else F.lit(-(1 << 63))).alias("turned"))

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most: dict[int, tuple[int, int]] = {}
        for batch in batches:
            own, ties = (column.to_numpy() for column in batch.columns)
            place = _place(bounds, turned, own, ties)
            by = np.lexsort((ties, own, place))
            ends = by[np.append(place[by][1:] != place[by][:-1], True)[: len(by)]]
            for row in zip(place[ends].tolist(), own[ends].tolist(), ties[ends].tolist()):
                most[row[0]] = max(most.get(row[0], row[1:]), row[1:])
        found = [(k, *top) for k, top in most.items()]
        columns = [pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * 3
        yield pa.RecordBatch.from_arrays(columns, names=["range", "id", "turned"])

    tops = rows.mapInArrow(largest, "range long, id long, turned long")
    tops = tops.groupBy("range").agg(F.max(F.struct("id", "turned")).alias("top")).collect()
    return bounds, turned, {row["range"]: tuple(row["top"]) for row in tops}


def _place(bounds: np.ndarray, turned: np.ndarray, ids: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """The range of each row: how many bounds stand at it or before it."""
    place = np.searchsorted(bounds, ids, side="right")
    first = np.searchsorted(bounds, ids, side="left")
    several = np.flatnonzero(place - first > 1)
    for begin in np.unique(first[several]).tolist():
        rows = several[first[several] == begin]
        end = int(place[rows[0]])
        place[rows] = begin + np.searchsorted(turned[begin:end], ties[rows], side="right")
    return place


def _tie():
    """What rows that share an id are ordered by."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _order_id():
    """Documents without an id stand behind all others."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))


def fingerprinted(docs: DataFrame, rows_in_range: int = RANGE_ROWS) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of each document.

    The edited text is the document with its last half, rounded down, replaced by as many of the first code
    points as the next document has; documents follow each other in descending ``doc_id``, the first follows
    the last. ``near_edited`` and ``near_next`` are the estimated Jaccard likeness of phrase sets. A null text
    is empty; an empty text has no phrases, and two of them are alike by 1. Null ids come last, rows that
    share an id stand in the order of a hash of their text. No rows give no rows.

    Ids are cut into ranges of equal counts, an id of many rows by those hashes, and each range's text is moved once,
    sorted within the range. The first row of a range is sent to the next range too, where it follows the last row.
    """
    bounds, turned, tops = _ranges(docs, rows_in_range)
    tied = bool((bounds[1:] == bounds[:-1]).any())
    order = sorted(tops)
    follows = {low: high for low, high in zip(order, order[1:])}  # the range that a range's first row is sent to
    if order:
        follows[order[-1]] = order[0]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).to_numpy()
            ties = ~batch.column(2).to_numpy() if tied else np.full(len(ids), -(1 << 63))
            own = _place(bounds, turned, ids, ties)
            keys = zip(own.tolist(), zip(ids.tolist(), ties.tolist()))
            first = np.array([k for k, (r, key) in enumerate(keys) if tops[r] == key], np.int64)
            for rows, extra in ((np.arange(len(ids)), False), (first, True)):
                taken = batch.take(pa.array(rows))
                to = [follows[r] for r in own[rows].tolist()] if extra else own[rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to, pa.int64()), pa.array([extra] * len(rows), pa.bool_()), *taken.columns],
                    names=["range", "extra", "doc_id", "id", "tie", "text"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        _order_id().alias("id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).select("doc_id", "id", _tie().alias("tie"), "text")
    return (
        rows.mapInArrow(place, "range long, extra boolean, doc_id long, id long, tie long, text string")
        .repartitionByRange("range")
        .sortWithinPartitions("range", "extra", F.desc("id"), "tie")
        .select("range", "extra", "doc_id", "text")
        .mapInArrow(tidy(compared), RESULT)
    )


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``doc_id, text``, the next document's text and whether that ends the range, for each document of a range."""
    before = None
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            for _, extra, doc_id, text in zip(*(column.to_pylist() for column in part.columns)):
                # the first extra row of the range ends it; what follows it there ties with it
                if before is not None and not before[0]:
                    yield before[1], before[2], text, extra
                before = extra, doc_id, text


def compared(
    batches: Iterator[pa.RecordBatch], most_rows: int = RESULT_ROWS, most_chars: int = GROUP_CHARS
) -> Iterator[pa.RecordBatch]:
    """The result's rows of sorted ``range, extra, doc_id, text``, compared in groups."""
    group, held, chars = [], None, 0
    for pair in _pairs(batches):
        group.append(pair)
        chars += len(pair[1])
        if len(group) == most_rows or chars >= most_chars:
            found, held = _compared(group, held)
            yield found
            group, chars = [], 0
    if group:
        yield _compared(group, held)[0]


def _compared(group: list[tuple], held: tuple | None) -> tuple[pa.RecordBatch, tuple | None]:
    """The result's rows of a group of ``_pairs`` and of the row ``held`` back of the group before.

    The group's last row is held back, as the next group has the minima that it is compared with, unless it ends
    its range.
    """
    rows, pairs = [], []
    for doc_id, text, after, _ in group:
        cut = len(text) // 2
        half = len(text) - cut
        edited = text[:half] + after[:cut]
        pairs.append((text, half, edited))
        rows.append((doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()))
    own, other = _fingerprints(pairs)
    following = np.concatenate([own[1:], own[:1]])
    for k, (_, _, after, ends) in enumerate(group):
        if ends:
            following[k] = fingerprint(after)
    if held is not None:
        rows = [held[0], *rows]
        following = np.concatenate([own[:1], following])
        own, other = np.concatenate([held[1][None], own]), np.concatenate([held[2][None], other])
    held = None if group[-1][3] else (rows[-1], own[-1], other[-1])
    n = len(rows) - (held is not None)
    columns = list(zip(*rows[:n])) or [(), (), ()]
    own, other, following = own[:n], other[:n], following[:n]
    arrays = [
        pa.array(columns[0], pa.int64()),
        pa.array(columns[1], pa.int64()),
        pa.array(columns[2], pa.string()),
        pa.array([written_as(x) for x in own], pa.string()),
        pa.array([written_as(x) for x in other], pa.string()),
        pa.array(_alike(own, other), pa.float64()),
        pa.array(_alike(own, following), pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in RESULT.split(", ")]), held
