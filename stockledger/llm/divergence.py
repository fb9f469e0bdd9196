"""How far the vocabularies of a language's sources lie apart, counted through transducers."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockledger.llm.layout import slices, tidy
from stockledger.llm.scratch import written
from stockledger.llm.transducer import FOLDED, Transducer, built

#: A language keeps the terms that so many of its documents hold.
LEAST_DOCUMENTS = 30
#: What is added to every count, and the whole that shares are parts of.
ADDED, WHOLE = 5, 1_000_000_000
#: Terms that stand out are ranked up to here.
MOST_TERMS = 50
#: Terms of one transducer, bytes of the transducers that one pass over the text holds.
SHARD_TERMS, PASS_BYTES = 1 << 16, 64 << 20
#: Counts that a task holds before it hands them on.
HELD = 1 << 20
#: Terms of a block that is compared at once, and counts in it.
BLOCK_TERMS, BLOCK_CELLS = 128, 1 << 21
# WHOLE in two factors: the long division by them stays below 2**63 up to counts of 2**48
_FACTORS = (31_250, 32_000)

# every byte of a term as it is, with A-Z as a-z, and a space for all others
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def texts_of(docs: DataFrame) -> DataFrame:
    """``lang, source, text`` without nulls."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def document_counts(rows: DataFrame, held: int = HELD) -> DataFrame:
    """``lang, term, n``: how many documents of a language hold a term; added up within tasks first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        room = held

        def out() -> Iterator[pa.RecordBatch]:
            for lang, counts in found.items():
                keys = list(counts)
                for k in range(0, len(keys), 1 << 16):
                    part = keys[k : k + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(part), pa.string()),
                            pa.array([key.decode() for key in part], pa.string()),
                            pa.array([counts[key] for key in part], pa.int64()),
                        ],
                        names=["lang", "term", "n"],
                    )

        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = part.column(1).cast(pa.large_binary()).to_pylist()
                for lang, text in zip(part.column(0).to_pylist(), texts, strict=True):
                    counts = found.setdefault(lang, Counter())
                    before = len(counts)
                    counts.update(set(text.translate(_TERM_BYTES).split()))
                    room -= len(counts) - before
                if room <= 0:
                    yield from out()
                    found, room = {}, held
        yield from out()

    parts = rows.select("lang", "text").mapInArrow(tidy(counted), "lang string, term string, n long")
    return parts.groupBy("lang", "term").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, term, ordinal``: each language's kept terms in the order of their bytes, from 0, written.

    Ranges of (lang, term) are sorted and numbered by themselves, then each takes the sum of those before it.
    """
    kept = counts.where(F.col("n") >= least).select("lang", "term")
    ranges = kept.repartitionByRange("lang", "term").withColumn("range", F.spark_partition_id())
    # the ranges are drawn from samples: they are fixed here before anything is numbered
    ranges = written(ranges, "terms")
    sizes = ranges.groupBy("lang", "range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("lang").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col("lang").alias("of"), F.col("range").alias("in"), before.alias("start"))
    place = F.row_number().over(W.partitionBy("lang", "range").orderBy("term")) - 1
    numbered = ranges.withColumn("place", place).join(
        starts, (F.col("lang") == F.col("of")) & (F.col("range") == F.col("in"))
    )
    return written(
        numbered.select("lang", "term", (F.col("start") + F.col("place")).cast("long").alias("ordinal")), "vocabulary"
    )


def shards_of(terms: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """``lang, shard, first, bytes, data``: a transducer for each ``shard_terms`` terms of a language, written."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ordinal")
        data = built(term.encode() for term in rows["term"]).packed()
        key = rows.iloc[0]
        return pd.DataFrame(
            [(key["lang"], key["shard"], key["term"], len(data), data)],
            columns=["lang", "shard", "first", "bytes", "data"],
        )

    cut = terms.withColumn("shard", F.floor(F.col("ordinal") / shard_terms).cast("long"))
    schema = "lang string, shard long, first string, bytes long, data binary"
    return written(cut.groupBy("lang", "shard").applyInPandas(build, schema), "transducers")


class Vocabulary:
    """Transducers of several shards, and which of them a word may be in."""

    def __init__(self, shards: list[tuple[str, int, str, bytes]], shard_terms: int):
        shards = sorted(shards, key=lambda s: (s[0], s[1]))
        self.joined = Transducer.joined([Transducer.unpacked(s[3]) for s in shards])
        self.base = np.array([s[1] * shard_terms for s in shards], np.int64)
        self.of: dict[str, tuple[int, np.ndarray]] = {}
        for k, (lang, _, first, _) in enumerate(shards):
            begin, heads = self.of.get(lang, (k, np.zeros(0, np.uint64)))
            self.of[lang] = begin, np.append(heads, _head(first.encode()))

    def ordinals(self, classes: np.ndarray, starts: np.ndarray, langs: np.ndarray, names: list[str]) -> np.ndarray:
        """The ordinal of each word among its language's terms, or -1."""
        found = np.full(len(starts), -1, np.int64)
        heads = None
        for k, name in enumerate(names):
            if name not in self.of:
                continue
            begin, firsts = self.of[name]
            mine = np.flatnonzero(langs == k)
            if len(firsts) == 1:
                span = [np.zeros(len(mine), np.int64), np.zeros(len(mine), np.int64)]
            else:
                heads = _heads(classes, starts) if heads is None else heads
                # terms with equal first bytes may lie in several shards
                span = [np.searchsorted(firsts, heads[mine], side) - 1 for side in ("left", "right")]
            shard = np.maximum(span[0], 0)
            while len(mine):
                root = begin + shard
                place = self.joined.places(classes, starts[mine], self.joined.roots[root])
                hit = place >= 0
                found[mine[hit]] = place[hit] + self.base[root[hit]]
                again = ~hit & (shard < span[1])
                mine, shard, span = mine[again], shard[again] + 1, [span[0][again], span[1][again]]
        return found


def _head(term: bytes) -> np.uint64:
    classes = FOLDED[np.frombuffer(term, np.uint8)]
    return _heads(np.append(classes, -1), np.zeros(1, np.int64))[0]


def _heads(classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The first eight bytes of each word as a number that sorts as they do."""
    head = np.zeros(len(starts), np.uint64)
    going = np.ones(len(starts), bool)
    for k in range(8):
        c = classes[np.minimum(starts + k, len(classes) - 1)]
        going = going & (c >= 0)
        head = head << np.uint64(8) | np.where(going, c + 1, 0).astype(np.uint64)
    return head


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with the sum of its counts."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[begins], np.add.reduceat(counts, begins) if len(keys) else counts


def recounted(rows: DataFrame, shards: list[tuple[str, int, str, bytes]], shard_terms: int, held: int = HELD) -> DataFrame:
    """``lang, source, ordinal, n``: occurrences of the shards' terms, added up within tasks; not across them."""
    sent = rows.sparkSession.sparkContext.broadcast(shards)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(sent.value, shard_terms)
        langs: dict[str, int] = {}
        groups: dict[tuple[int, str], int] = {}
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list[np.ndarray] = []
        n_waiting = 0

        def settle() -> None:
            nonlocal keys, counts, waiting, n_waiting
            fresh = np.concatenate([np.zeros(0, np.int64), *waiting])
            ones = np.ones(len(fresh), np.int64)
            keys, counts = _added(np.concatenate([keys, fresh]), np.concatenate([counts, ones]))
            waiting, n_waiting = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            names, of = list(langs), list(groups)
            group = keys >> 40
            for k in range(0, len(keys), 1 << 16):
                part = slice(k, k + (1 << 16))
                mine = [of[g] for g in group[part]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[lang] for lang, _ in mine], pa.string()),
                        pa.array([source for _, source in mine], pa.string()),
                        pa.array(keys[part] & ((1 << 40) - 1), pa.int64()),
                        pa.array(counts[part], pa.int64()),
                    ],
                    names=["lang", "source", "ordinal", "n"],
                )

        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = part.column(2).cast(pa.large_binary()).to_pylist()
                lang = [langs.setdefault(x, len(langs)) for x in part.column(0).to_pylist()]
                pairs = zip(lang, part.column(1).to_pylist(), strict=True)
                group = np.array([groups.setdefault(x, len(groups)) for x in pairs], np.int64)
                classes = FOLDED[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
                inside = classes >= 0
                starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
                begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
                text = np.searchsorted(begins, starts, "right") - 1
                ordinal = known.ordinals(classes, starts, np.array(lang)[text], list(langs))
                hit = ordinal >= 0
                waiting.append(group[text[hit]] << 40 | ordinal[hit])
                n_waiting += len(waiting[-1])
                if n_waiting >= held:
                    settle()
                if len(keys) >= held or len(groups) >= held:
                    settle()
                    yield from out()
                    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
                    langs, groups = {}, {}
        settle()
        yield from out()

    schema = "lang string, source string, ordinal long, n long"
    return rows.select("lang", "source", "text").mapInArrow(tidy(counted), schema)


def occurrences(
    rows: DataFrame, terms: DataFrame, shard_terms: int = SHARD_TERMS, pass_bytes: int = PASS_BYTES
) -> DataFrame:
    """``lang, source, ordinal, n`` over all texts: how often each group holds each kept term, where it does.

    The text streams through transducers of at most ``pass_bytes`` (or one, if that is larger) at a time; a
    vocabulary beyond that takes several passes over the text. Their number is the vocabulary's size over
    ``pass_bytes``, and only that much is fetched and broadcast for each.
    """
    shards = shards_of(terms, shard_terms)
    # a row for each shard_terms terms
    sizes = shards.select("lang", "shard", "bytes").orderBy("lang", "shard").collect()
    passes: list[list[tuple[str, int]]] = []
    room = 0
    for lang, shard, size in sizes:
        if not passes or size > room:
            passes.append([])
            room = pass_bytes
        passes[-1].append((lang, shard))
        room -= size
    parts = rows.sparkSession.createDataFrame([], "lang string, source string, ordinal long, n long")
    for held in passes:
        (first_lang, first), (last_lang, last) = held[0], held[-1]
        key = F.struct("lang", "shard")
        among = key.between(
            F.struct(F.lit(first_lang).alias("lang"), F.lit(first).cast("long").alias("shard")),
            F.struct(F.lit(last_lang).alias("lang"), F.lit(last).cast("long").alias("shard")),
        )
        found = shards.where(among).select("lang", "shard", "first", "data").collect()
        sent = [(r["lang"], r["shard"], r["first"], bytes(r["data"])) for r in found]
        parts = parts.unionByName(recounted(rows, sent, shard_terms))
    return parts.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def _shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(WHOLE * counts / totals) in whole numbers."""
    a, b = _FACTORS
    high, rest = np.divmod(counts * a, totals)
    return 1 + high * b + rest * b // totals


def compared(counts: DataFrame, groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, source, part, item, ordinal, value``: for blocks of terms what each pair of sources differs by in
    them, and the terms that stand out most in each source.

    ``counts`` as of ``occurrences``, ``groups``: every ``lang, source``, ``sizes``: ``lang, v`` with the number of
    kept terms. A block holds the counts of a few terms for all sources of a language, fewer terms where a language
    has very many sources; blocks are dealt out by language and number.
    """
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # every group with what its shares need
    known = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["total", "v"])
    known = written(known, "groups")
    langs = known.groupBy("lang").agg(F.sum("total").cast("long").alias("lang_total"), F.count("*").alias("sources"))
    # one width for all languages, so that counts find their block without a join on the language
    most = langs.agg(F.max("sources")).first()[0] or 1
    wide = max(1, min(BLOCK_TERMS, BLOCK_CELLS // most))
    last = F.greatest(F.lit(0), F.floor((F.col("v") - 1) / wide)).cast("long")
    zero = F.lit(0).cast("long")
    heads = (
        known.join(langs.drop("sources"), "lang")
        .withColumn("block", F.explode(F.sequence(zero, last)))
        .select("lang", "block", "source", "total", "lang_total", "v", (zero - 1).alias("ordinal"), zero.alias("n"))
    )
    cells = counts.select(
        "lang",
        F.floor(F.col("ordinal") / wide).cast("long").alias("block"),
        "source",
        *[zero.alias(c) for c in ("total", "lang_total", "v")],
        "ordinal",
        "n",
    )

    def compare(key, rows):
        lang, block = key
        is_head = rows["ordinal"].to_numpy() < 0
        head, cell = rows[is_head].sort_values("source"), rows[~is_head]
        names = head["source"].to_numpy()
        v = int(head["v"].iloc[0])
        width = min(wide, v - block * wide)
        held = np.zeros((len(names), max(width, 0)), np.int64)
        held[np.searchsorted(names, cell["source"].to_numpy()), cell["ordinal"].to_numpy() - block * wide] = cell["n"]
        found = {"source": [], "part": [], "item": [], "ordinal": [], "value": []}

        def put(source, part, item, ordinal, value) -> None:
            for name, x in zip(found, (source, part, item, ordinal, value), strict=True):
                found[name].append(np.asarray(x))

        n = len(names)
        if v:
            own = _shares(held + ADDED, head["total"].to_numpy()[:, None] + ADDED * v)
            whole = _shares(held.sum(axis=0) + ADDED, np.array([head["lang_total"].iloc[0] + ADDED * v]))
            for k in range(n):
                others = np.arange(n) != k
                apart = np.abs(own - own[k]).sum(axis=1)
                put(np.full(n - 1, names[k]), np.full(n - 1, "pair"), names[others], np.full(n - 1, -1), apart[others])
                stands = np.flatnonzero((held[k] > 0) & (own[k] > whole))
                most = stands[np.lexsort((stands, whole[stands] - own[k][stands]))][:MOST_TERMS]
                m = len(most)
                put(np.full(m, names[k]), np.full(m, "term"), np.full(m, ""), most + block * wide, (own[k] - whole)[most])
        else:
            for k in range(n):
                put(np.full(n - 1, names[k]), np.full(n - 1, "pair"), np.delete(names, k), np.full(n - 1, -1), np.zeros(n - 1, np.int64))
        table = pd.DataFrame({name: np.concatenate(x) if x else x for name, x in found.items()})
        table.insert(0, "lang", lang)
        return table

    schema = "lang string, source string, part string, item string, ordinal long, value long"
    dealt = heads.unionByName(cells).repartition("lang", "block")
    return dealt.groupBy("lang", "block").applyInPandas(compare, schema)


def _rank(*order: Column) -> Column:
    return F.row_number().over(W.partitionBy("lang", "source").orderBy(F.col("value").desc(), *order))


def audit(
    docs: DataFrame, least: int = LEAST_DOCUMENTS, shard_terms: int = SHARD_TERMS, pass_bytes: int = PASS_BYTES
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source of a language lies from each other, and the
    terms in which it goes furthest beyond the language.

    Terms are stretches of letters a-z, A-Z (lower-cased) and all characters beyond ASCII. A language keeps those
    that ``least`` of its rows hold. A group's share of a term is 1 + floor(10**9 * (count + 5) / (N + 5 * V)), all
    in whole numbers. Part ``pair``: the shares' differences from another source over all kept terms, all ranks.
    Part ``term``: terms that the group holds and whose share is over the language's, up to rank 50.

    Null texts, languages and sources count as empty ones, which make groups like others. Every row counts,
    whatever its id; equal rows count each. A group without terms has shares all the same; a language without kept
    terms has differences of 0; a language of one source has no pairs. Equal values rank by the bytes of the item,
    which is the order of ordinals for terms. An empty table gives no rows. Further columns are not read. A text is
    held whole, about 1 MB of shorter ones at once, at some 40 bytes for each byte.
    """
    rows = texts_of(docs)
    terms = vocabulary(document_counts(rows), least)
    counts = written(occurrences(rows, terms, shard_terms, pass_bytes), "occurrences")
    groups = rows.select("lang", "source").distinct()
    sizes = terms.groupBy("lang").agg(F.count("*").alias("v"))
    found = written(compared(counts, groups, sizes), "compared")
    pairs = (
        found.where(F.col("part") == "pair")
        .groupBy("lang", "source", "part", "item")
        .agg(F.sum("value").cast("long").alias("value"))
        .withColumn("rank", _rank(F.col("item")))
    )
    standing = (
        found.where(F.col("part") == "term").drop("item").withColumn("rank", _rank(F.col("ordinal")))
    ).where(F.col("rank") <= MOST_TERMS)
    named = standing.join(terms.withColumnRenamed("term", "item"), ["lang", "ordinal"])
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(named.select(*columns))
