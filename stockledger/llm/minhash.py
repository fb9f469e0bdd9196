"""Near-duplicate documents by b-bit minimum hashing, confirmed on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.llm.components import components
from stockledger.llm.layout import slices, tidy
from stockledger.llm.scratch import written
from stockledger.llm.words import mixed, shingles, words

#: Minima in a signature, bits kept of each, minima in a band. A pair at 0.75 shares no band with chance 5e-6.
MINIMA, BITS, ROWS = 128, 4, 4
PACKED = MINIMA * BITS // 64
#: How far an estimate may lie under the threshold: four standard deviations at 0.75.
SLACK = 0.16
#: The long signatures of what is compared within a band: minima of which one bit is kept, and their slack.
LONG_MINIMA, LONG_SLACK = 4096, 0.042
LONG_PACKED = LONG_MINIMA // 64
#: Ids that may be broadcast (8 bytes each); more are joined by shuffles.
BROADCAST_IDS = 1_000_000
#: Bands that join most of a large group before the others are looked at.
EARLY_BANDS = 4
#: Products of shingles and permutations that are made at once.
CHUNK = 1 << 20


def _permutations(n: int = MINIMA) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(n)
    return drawn.integers(0, 1 << 32, n, np.uint32) | np.uint32(1), drawn.integers(0, 1 << 32, n, np.uint32)


def signature(hashes: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The minimum of each permutation of a set of 64-bit hashes, 32 bits of it."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), np.uint32(0xFFFFFFFF))
    chunk = CHUNK // len(factors)
    for at in range(0, len(short), chunk):
        rows = short[at : at + chunk, None] * factors[None, :] + shifts[None, :]
        np.minimum(least, rows.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of a signature."""
    rows = least.reshape(-1, ROWS).astype(np.uint64)
    key = np.arange(len(rows), dtype=np.uint64)
    for k in range(ROWS):
        key = mixed((key << np.uint64(1)) + key + mixed(rows[:, k] + np.uint64(k + 1)))
    return key.astype(np.int64)


def packed(least: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The low bits of the mixed minima, next to each other in 64-bit integers.

    Unmixed, the low bits of two elements agree or differ alike under all permutations, since factors are odd.
    """
    places = np.arange(len(least), dtype=np.uint64) << np.uint64(32)
    low = (mixed(places ^ least) & np.uint64((1 << bits) - 1)).reshape(-1, 64 // bits)
    shifts = np.arange(64 // bits, dtype=np.uint64) * np.uint64(bits)
    return (low << shifts).sum(axis=1, dtype=np.uint64).astype(np.int64)


SIGNED = (
    "doc_id long, n_shingles long, key1 long, key2 long, "
    + ", ".join(f"s{k} long" for k in range(PACKED))
    + ", bands array<long>"
)


def signed(docs: DataFrame, size: int = 5) -> DataFrame:
    """Per document: ``doc_id, n_shingles``, two hashes of the whole set, the packed signature and the band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = _permutations()
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                hashes, bounds = words([x or "" for x in part.column(1).to_pylist()])
                n = part.num_rows
                counts, keys = np.zeros(n, np.int64), np.zeros((2, n), np.int64)
                short, bands = np.zeros((n, PACKED), np.int64), []
                for k in range(n):
                    own = shingles(hashes[bounds[k] : bounds[k + 1]], size)
                    counts[k] = len(own)
                    if not len(own):
                        bands.append(None)
                        continue
                    keys[0, k] = own.sum().astype(np.int64)
                    keys[1, k] = mixed(own ^ np.uint64(0x5851F42D4C957F2D)).sum().astype(np.int64)
                    least = signature(own, factors, shifts)
                    short[k] = packed(least)
                    bands.append(band_keys(least))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts), pa.array(keys[0]), pa.array(keys[1])]
                    + [pa.array(short[:, k]) for k in range(PACKED)]
                    + [pa.array(bands, pa.list_(pa.int64()))],
                    names=[x.split()[0] for x in SIGNED.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidy(run), SIGNED)


def estimate(left: str, right: str) -> Column:
    """The likeness of two packed signatures, less the share of low bits that agree by chance."""
    differing = None
    lowest = int("0001" * 16, 2) if BITS == 4 else None
    for k in range(PACKED):
        both = F.expr(f"{left}.s{k} ^ {right}.s{k}")
        both = both.bitwiseOR(F.shiftright(both, 2))
        both = both.bitwiseOR(F.shiftright(both, 1))
        n = F.bit_count(both.bitwiseAND(F.lit(lowest)))
        differing = n if differing is None else differing + n
    chance = 1 / (1 << BITS)
    return (1 - differing / F.lit(float(MINIMA)) - chance) / (1 - chance)


def long_estimate(left: str, right: str) -> Column:
    """The same from the long signatures, of whose bits half agree by chance."""
    differing = sum((F.bit_count(F.expr(f"{left}.l{k} ^ {right}.l{k}")) for k in range(LONG_PACKED)), F.lit(0))
    return 1 - differing * 2 / F.lit(float(LONG_MINIMA))


SHORT = [f"s{k}" for k in range(PACKED)]
LONG = [f"l{k}" for k in range(LONG_PACKED)]


def _chosen(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, text`` of the documents that a table of distinct ids names."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.join(ids, "doc_id", "left_semi")


def long_signed(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """``rep`` and the long signature of the documents that ``ids`` names."""
    schema = "rep long, " + ", ".join(f"{c} long" for c in LONG)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = _permutations(LONG_MINIMA)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                hashes, bounds = words([x or "" for x in part.column(1).to_pylist()])
                found = np.zeros((part.num_rows, LONG_PACKED), np.int64)
                for k in range(part.num_rows):
                    own = shingles(hashes[bounds[k] : bounds[k + 1]], size)
                    if len(own):
                        found[k] = packed(signature(own, factors, shifts), 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(found[:, k]) for k in range(LONG_PACKED))], names=["rep", *LONG]
                )

    rows = _chosen(docs, ids).mapInArrow(tidy(run), schema)
    return rows.groupBy("rep").agg(*(F.first(c).alias(c) for c in LONG))


def confirmed(docs: DataFrame, pairs: DataFrame, percent: int, size: int) -> DataFrame:
    """Those of the pairs ``a, b`` of ids whose whole shingle sets are alike by ``percent`` of a hundred."""
    ids = pairs.select(F.col("a").alias("doc_id")).distinct().union(pairs.select("b").distinct()).distinct()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                hashes, bounds = words([x or "" for x in part.column(1).to_pylist()])
                sets = [shingles(hashes[bounds[k] : bounds[k + 1]], size).tobytes() for k in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["id", "own"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            kept = []
            for k, (left, right) in enumerate(zip(columns[2], columns[3])):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    kept.append(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[k] for k in kept], pa.int64()) for c in columns[:2]], names=["a", "b"]
            )

    sets = written(_chosen(docs, ids).mapInArrow(tidy(build), "id long, own binary"), "sets", "none")
    return (
        pairs.select("a", "b")
        .join(sets.select(F.col("id").alias("a"), F.col("own").alias("left")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("own").alias("right")), "b")
        .select("a", "b", "left", "right")
        .mapInArrow(tidy(compare), "a long, b long")
    )


def near_duplicates(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each document.

    Two documents are linked when their sets of ``size``-word shingles share ``percent`` of a hundred of their
    union. Documents with one set are one class, so copies are never paired. A class goes into the bands of
    its signature. In some bands the classes are first held against one of them only, another one in each band; then,
    in every band, one class of each component that this gave is held against one of them. What that leaves in separate components is then compared within the band by the bit counts of long
    signatures, as a join condition, so that no pair of one component is made, and of others only those that
    are very close to the threshold. Every pair that an estimate lets through is confirmed on whole sets.

    Null and empty texts have no shingle, link with nothing and are components of their own. Rows that share
    an id are one node with the links of each. A document without an id links with nothing, has a null
    ``component_id`` and is kept. Extra columns don't matter; no rows give no rows.
    """
    table = written(signed(docs, size), "signed", "none")
    filled = table.where("n_shingles > 0 and doc_id is not null")
    classes = filled.groupBy("n_shingles", "key1", "key2").agg(F.min("doc_id").alias("rep"))
    same = ["n_shingles", "key1", "key2"]
    reps = (
        filled.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", *same], "left_semi")
        .withColumnRenamed("doc_id", "rep")
        .groupBy("rep")
        .agg(*(F.first(c).alias(c) for c in [*SHORT, "bands"]))
    )
    reps = written(reps, "classes", "none")
    members = reps.select("rep", F.posexplode("bands").alias("place", "band"))
    crowded = members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    shared = written(members.join(crowded, "band"), "bands", "none")
    short = reps.select("rep", *SHORT)

    def compared(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Pairs of each row with one of its band that the short signatures let through, and the links among them."""
        leaders = rows.groupBy("band").agg(F.min_by("rep", F.xxhash64("rep", "band")).alias("leader"))
        pairs = rows.join(leaders, "band").where("rep <> leader").select(
            F.least("leader", "rep").alias("a"), F.greatest("leader", "rep").alias("b")
        )
        pairs = written(
            pairs.distinct()
            .join(short.select(F.col("rep").alias("b"), *SHORT).alias("y"), "b")
            .join(short.select(F.col("rep").alias("a"), *SHORT).alias("x"), "a")
            .where(estimate("x", "y") >= percent / 100 - SLACK)
            .select("a", "b"),
            "pairs",
        )
        return pairs, written(confirmed(docs, pairs, percent, size), "near")

    def with_components(joined: DataFrame) -> DataFrame:
        """The members of bands with the component that they are in so far."""
        return shared.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(
            "band", "rep", F.coalesce("component", "rep").alias("component")
        )

    # a few bands join most of a large group; in all bands one member then stands for its component
    first, links = compared(shared.where(F.col("place") < EARLY_BANDS).select("band", "rep"))
    standing = with_components(components(links)).groupBy("band", "component").agg(
        F.min_by("rep", F.xxhash64("rep", "band")).alias("rep")
    )
    more, further = compared(written(standing.select("band", "rep"), "standing"))
    first, links = first.union(more), links.union(further)
    joined = components(links)

    # the bands that still hold several components
    labelled = with_components(joined)
    mixed_bands = (
        labelled.groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("band")
    )
    open_rows = written(labelled.join(mixed_bands, "band"), "open")
    ids = open_rows.select(F.col("rep").alias("doc_id")).distinct()
    signatures = reps.select("rep", *SHORT, "bands").join(long_signed(docs, ids, size), "rep")
    open_rows = written(open_rows.join(signatures, "rep"), "open", "none")
    second = (
        open_rows.alias("x")
        .join(
            open_rows.alias("y"),
            (F.col("x.band") == F.col("y.band"))
            & (F.col("x.component") < F.col("y.component"))
            & (estimate("x", "y") >= percent / 100 - SLACK)
            & (long_estimate("x", "y") >= percent / 100 - LONG_SLACK)
            # a pair comes out of the first band that it shares
            & F.expr("x.band = element_at(array_intersect(x.bands, y.bands), 1)"),
        )
        .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))
        .distinct()
        .join(first, ["a", "b"], "left_anti")
    )
    second = written(second, "pairs")
    if second.limit(1).count():
        joined = components(links.union(confirmed(docs, second, percent, size)))
    return (
        table.select("doc_id", "n_shingles", "key1", "key2")
        .join(classes, same, "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def without_near_duplicates(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, the one with the smallest id.

    Of rows that share an id one stays, the one with the smallest hash of its text; rows without an id all stay.
    """
    decided = near_duplicates(docs, percent, size).where("doc_id is not null")
    decided = written(
        decided.groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n")).where("not kept or n > 1"),
        "dropped",
    )
    if decided.count() <= BROADCAST_IDS:
        decided = F.broadcast(decided)
    rows = docs.withColumn("_id", F.col("doc_id").cast("long"))
    gone = decided.where("not kept").select(F.col("doc_id").alias("_id"))
    once = rows.join(gone, "_id", "left_anti")
    several = decided.where("kept").select(F.col("doc_id").alias("_id"))
    if not several.limit(1).count():
        return once.drop("_id")
    one = (
        once.join(several, "_id", "left_semi")
        .groupBy("_id")
        .agg(F.min_by(F.struct(*docs.columns), F.xxhash64("text")).alias("row"))
        .select("row.*")
    )
    return once.join(several, "_id", "left_anti").drop("_id").unionByName(one)
