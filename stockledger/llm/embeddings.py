"""Near-duplicate vectors with equal labels, found in a small-world graph for each shard."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.llm.components import components
from stockledger.llm.hnsw import Graph
from stockledger.llm.scratch import written

#: Vectors in a shard: what one task holds, with its graph, as an index and again as a block of queries.
SHARD_ROWS = 8192
#: How far below the threshold a node may lie for its neighbours to be looked at.
SLACK = 0.02
#: The most tasks that shards or their meetings are dealt to; each takes its share one after the other.
TASKS = 20_000
GRAPHS = "block string, shard int, ids array<long>, copies array<long>, vectors binary, graph binary, beam int"
FOUND = "rep long, links long, other long"


def usable(embedding: str = "embedding") -> Column:
    """Whether a vector can be compared: not null, no null or non-finite component, not zero."""
    v = F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares of tiny or huge numbers stay finite
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _build(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    rows = rows.sort_values("rep", kind="stable")
    vectors = _units(np.array(rows["embedding"].tolist(), np.float64))
    graph = Graph.build(vectors)
    return pd.DataFrame(
        {
            "block": [rows["block"].iloc[0]],
            "shard": [rows["shard"].iloc[0]],
            "ids": [rows["rep"].to_numpy()],
            "copies": [rows["copies"].to_numpy()],
            "vectors": [vectors.tobytes()],
            "graph": [graph.dump()],
            "beam": [graph.audited_beam(least - SLACK)],
        }
    )


def _ask(one: tuple, two: tuple, same: bool, threshold: float) -> pd.DataFrame:
    """The links between two shards: their number by vector of either, and a forest that joins the same nodes.

    Each shard's vectors ask the other's graph. Searches are directed and may miss, so a pair that one of the
    directions finds counts for both its ends.
    """
    (ids, copies, vectors, _, _), (own, held_copies, held, _, _) = one, two
    met = np.zeros((len(ids), len(own)), bool)

    def search(asking: np.ndarray, asked: tuple, hits: np.ndarray) -> None:
        graph = Graph.load(asked[2], asked[3])
        for k in range(len(asking)):
            near, likes = graph.search(asking[k], asked[4], threshold - SLACK)
            hits[k, near[likes >= threshold]] = True

    search(vectors, two, met)
    if same:
        met |= met.T
        np.fill_diagonal(met, False)
    else:
        search(held, one, met.T)
    shift = 0 if same else len(ids)
    nodes = ids if same else np.concatenate([ids, own])
    parent = np.arange(len(nodes))

    def roots(at: np.ndarray) -> np.ndarray:
        found = parent[at]
        while True:
            up = parent[found]
            if (up == found).all():
                return found
            found = up

    counts = np.zeros(len(nodes), np.int64)
    for k in range(len(ids)):
        near = np.flatnonzero(met[k])
        if not len(near):
            continue
        counts[k] += held_copies[near].sum()
        if not same:
            counts[near + shift] += copies[k]
        tops = np.unique(roots(np.append(near + shift, k)))
        parent[tops] = tops[0]
        parent[k] = tops[0]
    top = roots(np.arange(len(nodes)))
    tied = np.flatnonzero(top != np.arange(len(nodes)))
    linked = np.flatnonzero(counts)
    return pd.DataFrame(
        {
            "rep": np.concatenate([nodes[linked], nodes[tied]]),
            "links": np.concatenate([counts[linked], np.zeros(len(tied), np.int64)]),
            "other": pd.array(np.concatenate([nodes[linked], nodes[top[tied]]]), "Int64"),
        }
    )


def near_vectors(vectors: DataFrame, threshold: float = 0.93, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row.

    Vectors are linked when their labels are equal and not null, they have as many components and their cosine
    in double precision is ``threshold`` or more. Null and zero vectors and those with null or non-finite
    components link with nothing, as do rows without a label. Equal vectors of a label are one class: copies
    are counted, never paired. Each label's classes are spread over shards of about ``shard_rows`` by a hash of
    their smallest id, each shard gets a graph and a beam that its audit passes, and every shard's vectors ask
    every shard of their label; a pair that either end finds counts for both. Links leave a task as counts and as a forest, never as all pairs. A row without
    an id is compared with nothing: null component, no links, kept; rows that share an id are one node.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    rows = rows.withColumn(
        "block",
        F.when(
            usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull(),
            F.concat(F.size("embedding").cast("string"), F.lit("/"), F.col("label")),
        ),
    )
    classes = (
        rows.where("block is not null")
        .groupBy("block", "embedding")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    )
    classes = written(classes, "vector-classes")
    sizes = classes.groupBy("block").agg(F.ceil(F.count("*") / F.lit(shard_rows)).cast("int").alias("shards"))
    sharded = classes.join(sizes, "block").withColumn(
        "shard", F.pmod(F.xxhash64("rep"), F.col("shards").cast("long")).cast("int")
    )

    def build(part: pd.DataFrame) -> pd.DataFrame:
        return _build(part, threshold)

    n = sizes.agg(F.coalesce(F.sum("shards"), F.lit(1))).first()[0]
    graphs = written(
        sharded.select("block", "shard", "rep", "copies", "embedding")
        .repartition(min(n, TASKS), "block", "shard")  # one shard is work for a task, however few bytes it has
        .groupBy("block", "shard")
        .applyInPandas(build, GRAPHS),
        "graphs",
        "none",
    )

    def ask(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids, own = np.asarray(row.ids), np.asarray(row.own)
                one = np.frombuffer(row.vectors, np.float64).reshape(len(ids), -1)
                held = np.frombuffer(row.held, np.float64).reshape(len(own), -1)
                yield _ask(
                    (ids, np.asarray(row.copies), one, row.graph, row.beam),
                    (own, np.asarray(row.own_copies), held, row.own_graph, row.own_beam),
                    row.shard == row.to_shard,
                    threshold,
                )

    to = graphs.select(
        "block",
        F.col("shard").alias("to_shard"),
        F.col("ids").alias("own"),
        F.col("copies").alias("own_copies"),
        F.col("vectors").alias("held"),
        F.col("graph").alias("own_graph"),
        F.col("beam").alias("own_beam"),
    )
    meetings = graphs.select("block", "shard").join(graphs.select("block", F.col("shard").alias("to_shard")), "block")
    meetings = meetings.where("shard <= to_shard")
    tasks = max(1, min(meetings.count(), TASKS))
    found = written(
        meetings.join(graphs, ["block", "shard"])
        .join(to, ["block", "to_shard"])
        .select(
            *("shard", "to_shard", "ids", "copies", "vectors", "graph", "beam"),
            *("own", "own_copies", "held", "own_graph", "own_beam"),
        )
        .repartition(tasks)
        .mapInPandas(ask, FOUND),
        "vector-links",
    )
    joined = components(found.where("rep <> other").select("rep", "other"), "rep", "other")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    each = classes.join(counts, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    each = each.select(
        "block",
        "embedding",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    return (
        rows.join(each, ["block", "embedding"], "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
