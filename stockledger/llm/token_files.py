"""Token ids in files that an entropy coder keeps small and that are read in parallel."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger.llm import rans
from stockledger.llm.layout import PART, START, Mapper, ordered, part_starts, slices, tidy
from stockledger.llm.scratch import shared_folder
from stockledger.llm.tokens import encoder

BLOCK_IDS = 1 << 18
BLOCKS = (
    "part int, block long, start_in_part long, n_ids long, doc_ids array<long>, doc_lengths array<long>, payload binary"
)


TOKENISED = "doc_id long, n_tokens long, ids binary"


def tokeniser(tokenizer: str, end_id: int) -> Mapper:
    """Turns rows of ``doc_id, text`` into ``doc_id, n_tokens, ids``: the whole text's ids and ``end_id``, packed
    and compressed. Null text: empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, press = encoder(tokenizer), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids = coder.encode([text or "" for text in part.column(1).to_pylist()], end_id)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(x) // coder.dtype.itemsize for x in ids], pa.int64()),
                        pa.array([press.compress(x) for x in ids], pa.binary()),
                    ],
                    names=["doc_id", "n_tokens", "ids"],
                )

    return run


def unpacked(ids: bytes, dtype: np.dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(ids), dtype)


def id_counts(table: DataFrame, vocabulary: int, dtype: np.dtype) -> np.ndarray:
    """How often each id occurs: one row of ``vocabulary`` counts from each task, summed by id in Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                found += np.bincount(unpacked(ids.as_py(), dtype), minlength=vocabulary)
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(found[seen])], names=["id", "n"])

    rows = table.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(vocabulary, np.int64)
    counts[rows.column("id").to_numpy()] = rows.column("n").to_numpy()
    return counts


def write_token_files(
    docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, block_ids: int = BLOCK_IDS, bits: int = 20
) -> None:
    """Encodes every whole text, appends ``end_id`` and writes the ids in ascending ``doc_id`` to a folder.

    ``path/table`` holds the frequencies that all blocks share, ``path/parts`` the ids in each part and
    ``path/blocks`` one row for each block: its place (``part``, ``block``, ``start_in_part``), the documents
    in it with their lengths, and the payload of ``rans.encode``. A block ends with the first document that
    fills ``block_ids``, so each document lies in one block and a block is read without any other. Null texts
    are empty, null ``doc_id`` comes first, rows with one ``doc_id`` stand side by side; no rows give no block.
    """
    spark = docs.sparkSession
    coder = encoder(tokenizer)
    dtype, vocabulary = coder.dtype, coder.vocabulary
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = ordered(rows, ["doc_id"], "n_tokens", "token-ids", tokeniser(tokenizer, end_id), TOKENISED)
    frequencies = rans.Table.of(id_counts(table, vocabulary, dtype), bits)
    starts = part_starts(table, "n_tokens")
    spark.createDataFrame([(i, int(n)) for i, n in enumerate(frequencies.freq) if n], "id int, slots long").coalesce(
        1
    ).write.parquet(f"{path}/table")
    spark.createDataFrame([(vocabulary, bits)], "vocabulary int, bits int").coalesce(1).write.parquet(f"{path}/format")
    spark.createDataFrame(sorted(starts.items()), "part int, start long").coalesce(1).write.parquet(f"{path}/parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        filled = 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate([unpacked(x[4], dtype) for x in held])
            row = [
                [held[0][2]],
                [held[0][3]],
                [held[0][3]],
                [len(ids)],
                [[x[0] for x in held]],
                [[x[1] for x in held]],
                [rans.encode(ids, frequencies)],
            ]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=NAMES)

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                # another part, or rows that another task has read, begin another block
                if held and (filled >= block_ids or held[-1][2] != row[2] or held[-1][3] + held[-1][1] != row[3]):
                    yield block()
                    held, filled = [], 0
                held.append(row)
                filled += row[1]
        if held:
            yield block()

    table.select("doc_id", "n_tokens", PART, START, "ids").mapInArrow(tidy(run), BLOCKS).write.option(
        "compression", "none"
    ).parquet(f"{path}/blocks")


NAMES = [field.split()[0] for field in BLOCKS.split(", ")]


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files; ids as little-endian unsigned 32-bit.

    ``start`` counts the ids of all documents before it. A block whose checksums fail raises.
    """
    vocabulary, bits = spark.read.parquet(f"{path}/format").first()
    slots = spark.read.parquet(f"{path}/table").toArrow()  # no more rows than the vocabulary has
    scaled = np.zeros(vocabulary, np.int64)
    scaled[slots.column("id").to_numpy()] = slots.column("slots").to_numpy()
    frequencies = rans.Table(scaled, bits)
    starts = {row["part"]: row["start"] for row in spark.read.parquet(f"{path}/parts").collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start, doc_ids, lengths, payload in zip(*(column.to_pylist() for column in batch.columns)):
                ids = rans.decode(payload, frequencies).astype("<u4").tobytes()
                sizes = np.array(lengths, np.int64)
                ends = sizes.cumsum()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(starts[part] + start + ends - sizes),
                        pa.array(sizes),
                        pa.array([ids[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths)], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return (
        spark.read.parquet(f"{path}/blocks")
        .select("part", "start_in_part", "doc_ids", "doc_lengths", "payload")
        .mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids binary")
    )


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` as read back from files in the shared folder."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, tokenizer, path, end_id)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
