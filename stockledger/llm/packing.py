"""Packs documents into sequences of a fixed length along a space-filling curve."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.llm.layout import PART, START, ordered, part_starts, slices, tidy
from stockledger.llm.scratch import written
from stockledger.llm.token_files import unpacked
from stockledger.llm.tokens import encoder

#: Hashed features of a document vector, dimensions of the curve, bits of each.
FEATURES, AXES, AXIS_BITS = 512, 4, 10
PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """The place of each point (rows of ``axes`` integers under ``2**bits``) along the Hilbert curve.

    The published transpose form: undo the excess rotations from the top bit down, Gray-code the axes, then
    interleave their bits, the first axis' first.
    """
    x = points.astype(np.int64).T.copy()
    axes = len(x)
    high = 1 << (bits - 1)
    bit = high
    while bit > 1:
        low = bit - 1
        for i in range(axes):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        bit >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    bit = high
    while bit > 1:
        flip = np.where((x[axes - 1] & bit) != 0, flip ^ (bit - 1), flip)
        bit >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _projection(vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashed feature and sign of each id, and the axes' directions: the same in every task."""
    drawn = np.random.default_rng(2048)
    return (
        drawn.integers(0, FEATURES, vocabulary),
        drawn.choice(np.array([-1.0, 1.0]), vocabulary),
        drawn.standard_normal((FEATURES, AXES)),
    )


def curve_points(vectors: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Unit vectors' projections cut into ``2**AXIS_BITS`` steps; a projection of a unit vector is about normal."""
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = vectors / np.where(norms == 0, 1, norms)
    spread = 1 / (1 + np.exp(-1.702 * (unit @ directions)))
    return np.minimum((spread * (1 << AXIS_BITS)).astype(np.int64), (1 << AXIS_BITS) - 1)


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    """One row for each piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``.

    Documents are laid along a Hilbert curve through projections of their hashed token counts, so neighbours
    share words, and the line of all ids is cut every ``length`` ids: only the last sequence is not full.
    ``start`` counts the document's ids before the piece, ``doc_tokens`` all of them with ``end_id``, ``ids``
    are little-endian unsigned 32-bit. A null text is empty and gives one piece that holds ``end_id``. Rows
    with one ``doc_id`` are packed each on their own. Copies have one key and are told apart by ``doc_id``, so
    a large group of them spreads over partitions. No rows give no piece.
    """
    coder = encoder(tokenizer)
    dtype, vocabulary = coder.dtype, coder.vocabulary

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, press = encoder(tokenizer), zstandard.ZstdCompressor(level=1)
        feature, sign, directions = _projection(vocabulary)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids = coder.encode([text or "" for text in part.column(1).to_pylist()], end_id)
                vectors = np.empty((len(ids), FEATURES))
                for k, packed in enumerate(ids):
                    own = np.frombuffer(packed, dtype)
                    vectors[k] = np.bincount(feature[own], sign[own], FEATURES)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(hilbert_keys(curve_points(vectors, directions), AXIS_BITS)),
                        pa.array([len(x) // dtype.itemsize for x in ids], pa.int64()),
                        pa.array([press.compress(x) for x in ids], pa.binary()),
                    ],
                    names=["doc_id", "curve", "doc_tokens", "ids"],
                )

    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        tidy(tokenise), "doc_id long, curve long, doc_tokens long, ids binary"
    )
    keyed = written(keyed, "curve-keys", "none")  # the ranges are drawn from it
    line = ordered(keyed, ["curve", "doc_id"], "doc_tokens", "curve")
    starts = part_starts(line, "doc_tokens")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "ids"):
                rows: list[tuple] = []
                for doc_id, total, part, at, packed in zip(*(column.to_pylist() for column in some.columns)):
                    ids = unpacked(packed, dtype).astype("<u4").tobytes()
                    place, done = starts[part] + at, 0
                    while done < total:
                        offset = (place + done) % length
                        size = min(length - offset, total - done)
                        rows.append(
                            (doc_id, done, size, total, (place + done) // length, offset, ids[4 * done : 4 * (done + size)])
                        )
                        done += size
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns[:6]), pa.array(columns[6], pa.binary())],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    return line.select("doc_id", "doc_tokens", PART, START, "ids").mapInArrow(tidy(cut), PIECES)


def packed_pieces(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces with the crc32 of their ids in place of the ids."""
    return pack(docs, tokenizer).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
