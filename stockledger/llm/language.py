"""Language of a text by cross-parsing it against labelled text of each language."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger.llm.layout import slices, tidy

UNKNOWN = "und"
#: Code points of a language's text that its automaton is built from, and of one document that go into it.
TRAIN_CHARS, DOCUMENT_CHARS = 40_000, 1_000
#: Characters with a column of their own in a language's table; rarer ones match nothing.
ALPHABET = 255
#: Code points that are parsed in one go; a longer text is parsed in stretches of this length.
STRETCH = 4096
#: All but letters.
BETWEEN = re.compile(r"[\W\d_]+")
#: Slots that documents are hashed to for the training sample.
SLOTS = 1 << 20


class Automaton:
    """The suffix automaton of a text as one table: the next state by state and character.

    An entry is the next state's row, or its bitwise complement where the phrase ends before the character
    and the next one begins with it. State 0 reads the empty string; the last state stands behind a character
    that the text does not hold, so whatever follows begins a phrase.
    """

    def __init__(self, text: str):
        points, counts = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), return_counts=True)
        kept = np.sort(points[np.lexsort((points, -counts))[:ALPHABET]])
        self.size = max(2, len(text))
        self.width = len(kept) + 1
        self.columns = np.zeros(0x110000, np.uint8)
        self.columns[kept] = np.arange(1, len(kept) + 1)
        symbols = self.columns[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")].tolist()
        edges = _suffix_automaton(symbols)
        behind = len(edges)
        if (behind + 1) * self.width >= 1 << 31:
            raise ValueError("the labelled text is too long for one table")
        root = np.full(self.width, ~(behind * self.width), np.int32)
        for symbol, state in edges[0].items():
            if symbol:
                root[symbol] = ~(state * self.width)
        table = np.tile(root, (behind + 1, 1))
        for state, out in enumerate(edges):
            for symbol, target in out.items():
                if symbol:
                    table[state, symbol] = target * self.width
        self.start = behind * self.width
        self.table = table.reshape(-1)

    def phrases(self, points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """How many phrases each stretch of ``points`` parses into; stretches come longest first."""
        symbols = self.columns[points]
        state = np.full(len(starts), self.start, np.int32)
        ended = np.zeros(len(starts), np.int32)
        longest = int(lengths[0]) if len(lengths) else 0
        alive = np.searchsorted(-lengths, -np.arange(longest), side="left")
        for step, m in enumerate(alive.tolist()):
            entry = self.table[state[:m] + symbols[starts[:m] + step]]
            sign = entry >> 31
            ended[:m] -= sign
            state[:m] = entry ^ sign
        return ended


def _suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """The edges of each state, by the usual on-line construction."""
    edges: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in symbols:
        state = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in edges[at]:
            edges[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = edges[at][symbol]
            if length[at] + 1 == length[target]:
                link[state] = target
            else:
                twin = len(edges)
                edges.append(dict(edges[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and edges[at].get(symbol) == target:
                    edges[at][symbol] = twin
                    at = link[at]
                link[target] = link[state] = twin
        last = state
    return edges


def plain(text: str) -> str:
    """The text in lower case with one space for whatever stands between letters."""
    return BETWEEN.sub(" ", text.lower())


@lru_cache(maxsize=2)
def _automata(model: tuple[tuple[str, str], ...]) -> list[Automaton]:
    return [Automaton(text) for _, text in model]


def training_text(
    docs: DataFrame, train_chars: int = TRAIN_CHARS, document_chars: int = DOCUMENT_CHARS
) -> tuple[tuple[str, str], ...]:
    """``(lang, text)`` of each labelled language, as the model that ``identify`` takes.

    A language's text is put together from a bounded sample of its documents: in the order of a hash of their
    ids, at most ``document_chars`` of each, until there are ``train_chars``. The hash bound that a document
    must stay under follows from the language's count, so no more than some times that text reaches the driver.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0)).select(
        F.col("lang").cast("string").alias("lang"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.substring("text", 1, document_chars).alias("text"),
        F.xxhash64("doc_id", "text").alias("hash"),
    )
    sizes = labelled.groupBy("lang").agg(
        F.count("*").alias("n"), F.sum(F.length("text").cast("double")).alias("chars")
    ).collect()
    if not sizes:
        return ()
    bounds = F.create_map(
        *(
            F.lit(x)
            for row in sizes
            for x in (row["lang"], math.ceil(SLOTS * min(1.0, (4 * train_chars + 32 * document_chars) / row["chars"])))
        )
    )
    sample = labelled.where(F.pmod("hash", F.lit(SLOTS)) < bounds[F.col("lang")]).collect()
    model = []
    for lang in sorted({row["lang"] for row in sizes}):
        rows = sorted(
            (row for row in sample if row["lang"] == lang), key=lambda row: (row["hash"], row["doc_id"] or 0)
        )
        text, held = [], 0
        for row in rows:
            if held >= train_chars:
                break
            text.append(plain(row["text"]))
            held += len(text[-1]) + 1
        model.append((lang, "\n".join(text)[:train_chars]))
    return tuple((lang, text) for lang, text in model if text)


def predict(texts: list[str | None], model: tuple[tuple[str, str], ...]) -> list[tuple[str, float]]:
    """Language and score of each text.

    A language's figure is the bits that its phrases take, ``phrases * log2(size of its text) / length``; the
    smallest wins, the first by name among equals. The score is one minus the smallest over the next.
    """
    automata = _automata(model)
    lower = [plain(text) if text and any(map(str.isalpha, text)) else "" for text in texts]
    points = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), "<u4")
    starts, lengths, owner, at = [], [], [], 0
    for k, text in enumerate(lower):
        for begin in range(0, len(text), STRETCH):
            starts.append(at + begin)
            lengths.append(min(STRETCH, len(text) - begin))
            owner.append(k)
        at += len(text)
    order = np.argsort(-np.array(lengths, np.int64), kind="stable")
    starts, lengths, owner = (np.array(x, np.int64)[order] for x in (starts, lengths, owner))
    sizes = np.array([max(1, len(text)) for text in lower])
    figures = np.empty((len(texts), len(automata)))
    for k, automaton in enumerate(automata):
        phrases = np.bincount(owner, automaton.phrases(points, starts, lengths), len(texts))
        figures[:, k] = phrases * math.log2(automaton.size) / sizes
    found: list[tuple[str, float]] = []
    for text, row in zip(lower, figures):
        if not text or not len(row):
            found.append((UNKNOWN, 0.0))
            continue
        best = int(np.argmin(row))
        rest = np.delete(row, best)
        found.append((model[best][0], float(1 - row[best] / rest.min()) if len(rest) else 1.0))
    return found


def identify(docs: DataFrame, model: tuple[tuple[str, str], ...], text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` (string) and ``score`` (double), columns of these names replaced.

    A null text, or one without a letter, is ``und`` with score 0, as is every text where nothing is labelled.
    All of a text counts. Rows keep their other columns, repeated rows get equal results.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = kept.index(text)
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*docs.select(kept).schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, 4 << 20):
                found = predict(part.column(at).to_pylist(), model)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(list(x[0] for x in found), pa.string()), pa.array([x[1] for x in found])],
                    names=schema.names,
                )

    return docs.select(kept).mapInArrow(tidy(run), schema)


def fold(doc_id: str = "doc_id") -> Column:
    """The crc32 of a document's id as text, by five: 0 for those that are kept from training."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``, learned from the documents that are not held out.

    A document without an id is neither held out nor learned from.
    """
    model = training_text(docs.where(fold() != 0))
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return identify(rows, model).drop("text")
