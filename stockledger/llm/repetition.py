"""How much of a document repeats itself: characters inside n-grams and lines that occur more than once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.llm.layout import slices, tidy

#: Words in the windows that the base rule looks at.
BASE_LENGTH = 3
#: Documents with fewer words fail, as do those with more than half of their words in repeated windows.
LEAST_WORDS, MOST_REPEAT_WORDS = 50, 50
#: Fixed values of published repetition rules: the most percent of a text's characters inside n-grams that it has
#: held before.
MOST_IN_NGRAMS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
#: The same for lines that repeat an earlier one.
MOST_IN_LINES = 20

SYMBOLS = b"#*$%&|<>"
BLANKS = b"\t\n\v\f\r "
_NOT_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))
_LEADS = np.array([byte & 0xC0 != 0x80 for byte in range(256)])
_BLANK = np.array([byte in BLANKS for byte in range(256)])

#: Two primes below 2**31 and a base for each: products fit in 64 bits, both remainders make one key of 62.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_327_217_885, 1_862_914_763)

SIZES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "dup_line_chars", "n_repeat_words")


def repeated_windows(
    codes: np.ndarray, owner: np.ndarray, room: np.ndarray, lengths: Sequence[int]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length, in rising order: where windows begin that their text holds twice or more, and which of
    them are not the first.

    ``codes`` numbers the words, ``owner`` the texts, ``room`` is how many words of its text follow a word, itself
    included. The hash of a window comes from the one that is a word shorter. Only windows whose shorter one
    repeats go on, so a text without repeats costs one sort. Windows of equal hash are compared word by word.
    """
    at = np.flatnonzero(room >= 1)
    hashes = [owner[at].astype(np.uint64) % np.uint64(p) for p in PRIMES]
    for n in range(1, max(lengths) + 1):
        fits = room[at] >= n
        at = at[fits]
        added = codes[at + (n - 1)].astype(np.uint64) + np.uint64(1)
        hashes = [
            (h[fits] * np.uint64(b) + added) % np.uint64(p) for h, b, p in zip(hashes, BASES, PRIMES, strict=True)
        ]
        if n < min(lengths):
            continue
        number, leader = _equal_windows(hashes[0] << np.uint64(31) | hashes[1], codes, owner, at, n)
        repeats = np.bincount(number, minlength=1)[number] > 1
        later = (leader != at)[repeats]
        at, hashes = at[repeats], [h[repeats] for h in hashes]
        if n in lengths:
            yield n, at, later


def _equal_windows(
    keys: np.ndarray, codes: np.ndarray, owner: np.ndarray, at: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each window the number of its class of equal windows of one text, and where the first of them begins."""
    order = np.argsort(keys, kind="stable")
    if not len(order):
        return order, at
    first = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
    leader = at[order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]]
    own = at[order]
    alike = owner[own] == owner[leader]
    for k in range(n):
        alike &= codes[own + k] == codes[leader + k]
    if not alike.all():  # different windows with one hash: number the windows themselves
        rows = np.stack([owner[at], *(codes[at + k] for k in range(n))], axis=1)
        _, begins, number = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        return number.ravel(), at[begins][number.ravel()]
    number, found = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    number[order], found[order] = np.cumsum(first) - 1, leader
    return number, found


def _covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in one of the windows."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + n, -1)
    return np.cumsum(change[:-1]) > 0


def measures(texts: list[bytes], lengths: Sequence[int]) -> dict[str, np.ndarray]:
    """The figures of each text: ``SIZES``, and the characters in repeated windows of each length."""
    numbers: dict[bytes, int] = {}
    codes: list[int] = []
    found = {name: np.zeros(len(texts), np.int64) for name in SIZES}
    for k, text in enumerate(texts):
        own = text.split()  # of bytes: at the six blanks and nowhere else
        codes += [numbers.setdefault(word, len(numbers)) for word in own]
        found["n_words"][k] = len(own)
        found["n_symbols"][k] = len(text.translate(None, _NOT_SYMBOLS))
        seen: set[bytes] = set()
        for line in text.split(b"\n"):
            if line.isspace() or not line:
                continue
            if line in seen:
                found["n_dup_lines"][k] += 1
                found["dup_line_chars"][k] += len(line.translate(None, BLANKS).decode())
            seen.add(line)
    code = np.array(codes, np.int64)
    n_words = found["n_words"]
    owner = np.repeat(np.arange(len(texts)), n_words)
    ends = np.cumsum(n_words)
    room = ends[owner] - np.arange(len(code))

    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    blank = _BLANK[data]
    change = np.flatnonzero(np.diff(np.concatenate([[True], blank])))
    leads = np.concatenate([[0], np.cumsum(_LEADS[data] & ~blank)])
    chars = leads[change[1::2]] - leads[change[0::2]]

    def summed(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[ends] - sums[ends - n_words]

    found["word_chars"] = summed(chars)
    for n in lengths:
        found[f"in_{n}_grams"] = np.zeros(len(texts), np.int64)
    for n, at, later in repeated_windows(code, owner, room, sorted({BASE_LENGTH, *lengths})):
        if n == BASE_LENGTH:
            found["n_repeat_words"] = summed(_covered(at, n, len(code)).astype(np.int64))
        if n in lengths:
            found[f"in_{n}_grams"] = summed(np.where(_covered(at[later], n, len(code)), chars, 0))
    return found


def repetition(
    docs: DataFrame, lengths: Sequence[int] = tuple(MOST_IN_NGRAMS), slice_bytes: int = 1 << 20
) -> DataFrame:
    """``doc_id`` and, for each document, how much of it repeats.

    Words are stretches without space, tab, line feed, vertical tab, form feed and carriage return. ``n_words``,
    ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (with a word, equal to an earlier one),
    ``dup_line_chars`` (code points in their words), ``n_repeat_words`` (words in windows of three that the text
    holds twice or more, the first included) and ``in_N_grams`` (code points of words in windows of N
    words that the text holds earlier).

    Every row of ``docs`` gives a row, whatever its id: null, repeated or tied ids stay. A null text counts as an
    empty one, for which all figures are 0, as they are for a text of blanks. No rows give no rows. Further
    columns are not read. There is no shuffle. A task holds about ``slice_bytes`` of text at once, or one text if
    that is longer: some 150 bytes for each of its words.
    """
    names = [*SIZES, *(f"in_{n}_grams" for n in lengths)]
    kind = docs.schema["doc_id"].dataType.simpleString()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", slice_bytes):
                texts = [value or b"" for value in part.column(1).cast(pa.large_binary()).to_pylist()]
                figures = measures(texts, lengths)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(figures[name], pa.int64()) for name in names)],
                    names=["doc_id", *names],
                )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidy(measured), f"doc_id {kind}, " + ", ".join(f"{name} long" for name in names))


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEAT_WORDS * F.col("n_words")
    )


def repeats_too_much(most: dict[int, int]) -> Column:
    """Whether n-grams or lines that occur more than once cover too much of a document."""
    too_much = 100 * F.col("dup_line_chars") > MOST_IN_LINES * F.col("word_chars")
    for n, percent in most.items():
        too_much = too_much | (100 * F.col(f"in_{n}_grams") > percent * F.col("word_chars"))
    return too_much


def judged(docs: DataFrame, most: dict[int, int] | None = None) -> DataFrame:
    """``repetition`` with ``base_failed`` and ``kept``; a document fails the base by a lack of words, too."""
    most = MOST_IN_NGRAMS if most is None else most
    return (
        repetition(docs, tuple(most))
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~repeats_too_much(most))
    )
