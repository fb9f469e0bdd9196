"""Document rates whose expected tokens by domain meet targets, from a classifier's soft membership."""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger.llm.layout import slices, tidy
from stockledger.llm.scratch import written
from stockledger.llm.words import words

#: The most labelled documents that the classifier is fitted on, with their whole texts.
SAMPLE_ROWS = 4000
#: Hashed words are features; passes over the sample, ridge.
FEATURES, PASSES, RIDGE = 1 << 15, 200, 1e-4
SLOTS = 1 << 20


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct features of all texts in a row, whose they are, and each text's number of words."""
    hashes, bounds = words(texts)
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(texts)), counts)
    pairs = np.unique(owner * FEATURES + (hashes % np.uint64(FEATURES)).astype(np.int64))
    return pairs % FEATURES, pairs // FEATURES, counts


class Classifier:
    """Multinomial logistic regression on which words a text has, each text's features scaled to length one."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        self.weights, self.bias = weights, bias

    def posteriors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The domains' probabilities and the number of words of each text."""
        features, owner, counts = _features(texts)
        return _softmax(_scores(features, owner, len(texts), self.weights, self.bias)), counts

    @classmethod
    def fit(cls, texts: list[np.ndarray], domains: np.ndarray, n_domains: int) -> Classifier:
        """From the distinct features of each text."""
        n = len(texts)
        features = np.concatenate(texts).astype(np.int64)
        owner = np.repeat(np.arange(n), [len(own) for own in texts])
        sizes = np.maximum(1, np.bincount(owner, minlength=n))
        scale = (1 / np.sqrt(sizes))[owner]
        wanted = np.eye(n_domains)[domains]
        weights = np.zeros((FEATURES, n_domains))
        shares = (wanted.sum(axis=0) + 1) / (n + n_domains)
        bias = np.log(shares)
        step_w, step_b = np.zeros_like(weights), np.zeros_like(bias)
        for _ in range(PASSES):  # gradient steps, each weight's shortened by what it has moved so far
            off = (_softmax(_scores(features, owner, n, weights, bias)) - wanted) / n
            slope = RIDGE * weights
            for k in range(n_domains):
                slope[:, k] += np.bincount(features, off[owner, k] * scale, FEATURES)
            step_w += slope**2
            step_b += off.sum(axis=0) ** 2
            weights -= 0.5 * slope / np.sqrt(step_w + 1e-12)
            bias -= 0.1 * off.sum(axis=0) / np.sqrt(step_b + 1e-12)
        return cls(weights.astype(np.float32), bias)


def _scores(features: np.ndarray, owner: np.ndarray, n: int, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    sizes = np.maximum(1, np.bincount(owner, minlength=n))
    sums = [np.bincount(owner, weights[features, k], n) for k in range(weights.shape[1])]
    return np.stack(sums, axis=1) / np.sqrt(sizes)[:, None] + bias


def _softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def fit_domains(docs: DataFrame, labelled: DataFrame, domains: list[str], sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """A classifier of ``domains`` from the documents that ``labelled`` (``doc_id, domain``) names.

    It is fitted on the whole texts of at most ``sample_rows`` of them, those with the smallest hashes of their
    ids. Tasks turn the texts into features, so the driver gets at most FEATURES small numbers of each. Without a
    labelled document all domains are equally likely.
    """
    known = labelled.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "domain"
    )
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    n = known.count()
    bound = math.ceil(SLOTS * min(1.0, 1.2 * sample_rows / max(1, n)))
    hashed = known.withColumn("hash", F.xxhash64("doc_id")).where(F.pmod("hash", F.lit(SLOTS)) < bound)
    chosen = hashed.orderBy(F.pmod("hash", F.lit(SLOTS)), "doc_id").limit(sample_rows)
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .where(F.col("text").isNotNull())
        .join(F.broadcast(chosen), "doc_id")  # sample_rows at most
        .groupBy("doc_id", "hash", "domain")
        .agg(F.min("text").alias("text"))
    )

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                own = [_features([text])[0].astype("<i4").tobytes() for text in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(own, pa.binary())], names=["doc_id", "hash", "domain", "features"]
                )

    rows = (
        texts.select("doc_id", "hash", "domain", "text")
        .mapInArrow(tidy(seen), "doc_id long, hash long, domain string, features binary")
        .toArrow()
        .sort_by([("hash", "ascending"), ("doc_id", "ascending")])
    )
    if not rows.num_rows:
        return Classifier(np.zeros((FEATURES, len(domains)), np.float32), np.zeros(len(domains)))
    place = {domain: k for k, domain in enumerate(domains)}
    return Classifier.fit(
        [np.frombuffer(own, "<i4") for own in rows.column("features").to_pylist()],
        np.array([place[d] for d in rows.column("domain").to_pylist()]),
        len(domains),
    )


def memberships(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """``docs`` with ``n_tokens`` (words) and ``posteriors`` (array of doubles), from whole texts."""
    kept = [c for c in docs.columns if c not in ("n_tokens", "posteriors")]
    at = kept.index("text")
    schema = T.StructType(
        [
            *docs.select(kept).schema.fields,
            T.StructField("n_tokens", T.LongType()),
            T.StructField("posteriors", T.ArrayType(T.DoubleType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                shares, counts = classifier.posteriors([x or "" for x in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(counts, pa.int64()), pa.array(shares.tolist(), pa.list_(pa.float64()))],
                    names=schema.names,
                )

    return docs.select(kept).mapInArrow(tidy(run), schema)


def _sums(table: DataFrame, shifts: list[np.ndarray], width: int) -> list[tuple[np.ndarray, float, np.ndarray]]:
    """For each candidate in one pass: tokens at its rates by domain, half the tokens times squared rates, and the
    domains' token-weighted products over the documents with a rate above zero."""
    size = width + 1 + width * width

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(shifts), size))
        for batch in batches:
            tokens, shares = _columns(batch, width)
            for k, shift in enumerate(shifts):
                own = rates(shares, shift)
                weighed = shares * (tokens * (own > 0))[:, None]
                sums[k] += np.concatenate(
                    [(tokens * own) @ shares, [0.5 * (tokens * own) @ own], (weighed.T @ shares).ravel()]
                )
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(sums.size), pa.int32()), pa.array(sums.ravel())], names=["k", "v"]
        )

    rows = (
        table.select("n_tokens", "posteriors")
        .mapInArrow(tidy(add), "k int, v double")
        .groupBy("k")
        .agg(F.sum("v").alias("v"))
        .toArrow()
    )
    flat = np.zeros(len(shifts) * size)
    flat[rows.column("k").to_numpy()] = rows.column("v").to_numpy()
    found = flat.reshape(len(shifts), size)
    return [(x[:width], float(x[width]), x[width + 1 :].reshape(width, width)) for x in found]


def _columns(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    shares = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64), shares


def rates(shares: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """The documents' rates: moved from one along the gradient by all steps together, and put back to zero or more."""
    return np.maximum(0, 1 - shares @ shift)


def fit_rates(
    table: DataFrame, targets: np.ndarray, near: float = 1e-4, held: float = 1e-7, most: int = 60
) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the gradient steps that take rates from one to where each domain's expected tokens are its target,
    and the totals that are reached.

    Projected gradient on the least squares of the domain totals, in the form that sums the steps and projects
    once: a document's rate is one less its posteriors times the ``shift``, kept at zero or more. Of all rates that
    meet the targets these change the corpus least, by the squares weighted with tokens. Steps are scaled by the
    products of the domains over the documents above zero, and by those of all documents, with which a step surely
    descends; one pass over the documents evaluates several lengths, and the best is taken. What is minimised is
    convex, so it has one best value, and ``held``, a small weight on the shift, keeps that within reach for targets
    that no rates can meet: then the totals come as near to them as the posteriors allow. Ends when all totals are
    within ``near`` of all tokens, or when no length gains any more. Only the shift, a number for each domain, is
    carried along, so a pass costs the same however many there were.
    """
    width = len(targets)
    scale = max(1.0, float(np.abs(targets).sum()))
    weight = held * scale
    shift = np.zeros(width)
    totals, half, products = _sums(table, [shift], width)[0]
    everyone = products

    def value(half: float, at: np.ndarray) -> float:
        return half + float(targets @ at) + 0.5 * weight * float(at @ at)

    best = value(half, shift)
    for _ in range(most):
        slope = targets - totals + weight * shift
        if np.abs(totals - targets).max() <= near * scale or np.abs(slope).max() <= 1e-9 * scale:
            break
        own, safe = (np.linalg.solve(p + weight * np.eye(width), slope) for p in (products, everyone))
        lengths = (2.0, 1.0, 0.5, 0.2, 0.08, 0.03, 0.01, 0.003)
        tried = [shift - length * own for length in lengths] + [shift - length * safe for length in (1.0, 4.0, 16.0)]
        found = _sums(table, tried, width)
        values = [value(x[1], at) for x, at in zip(found, tried, strict=True)]
        k = int(np.argmin(values))
        if values[k] >= best - 1e-13 * abs(best):
            break
        best, shift = values[k], tried[k]
        totals, _, products = found[k]
    return shift, totals


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float],
    factor: float = 1.0,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``posteriors`` (in the order of ``targets``), ``rate``, ``copies`` and ``miss``.

    ``targets`` gives each domain's weight in the mixture; their tokens add up to ``factor`` times the corpus.
    Rates are nonnegative, and the expected tokens of a domain, the sum of rate x tokens x posterior, come as
    near to its target as the posteriors allow. ``miss``, the same in every row, is by how much the domain that is
    furthest from its target misses it, as a share of all tokens; beyond 0.001 there is a warning. ``copies`` is the rate rounded up or down by a hash of the id
    and text, so that its expectation is the rate; a document may be repeated or left out. Null texts are
    empty: no tokens, the domains' general shares. Rows that are equal get equal results. No rows give none. Texts are
    read whole, about 1 MB at once or one text if that is longer, at some 60 bytes for each of its bytes.
    """
    domains = list(targets)
    classifier = fit_domains(docs, labelled, domains, sample_rows)
    drop = [c for c in ("rate", "copies", "miss") if c in docs.columns]
    table = written(memberships(docs.drop(*drop), classifier), "memberships")
    n_tokens = table.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    weights = np.array([targets[d] for d in domains], np.float64)
    wanted = weights / weights.sum() * factor * n_tokens
    shift, totals = fit_rates(table, wanted)
    miss = float(np.abs(totals - wanted).max()) / max(1.0, float(wanted.sum()))
    if miss > 1e-3:
        reached = dict(zip(domains, np.round(totals / max(1.0, float(wanted.sum())), 4).tolist(), strict=True))
        warnings.warn(f"the documents can't meet {dict(targets)}: they come to {reached}", stacklevel=2)
    width = len(domains)
    schema = T.StructType([*table.schema.fields, T.StructField("rate", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, own = _columns(batch.select(["n_tokens", "posteriors"]), width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates(own, shift))], names=schema.names)

    chance = F.pmod(F.xxhash64("doc_id", "text", F.lit("copies")), F.lit(SLOTS)) / F.lit(SLOTS)
    mixed = table.mapInArrow(tidy(run), schema).withColumn("copies", F.floor(F.col("rate") + chance).cast("long"))
    return mixed.withColumn("miss", F.lit(miss))
