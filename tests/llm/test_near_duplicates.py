import re
import string

import numpy as np
import pytest

from stockledger.llm import embeddings, minhash
from stockledger.llm.components import components
from stockledger.llm.hnsw import Graph
from stockledger.llm.words import shingles, words
from tests.llm.rows import clashing, colliding_words, documents, edge_texts, prose

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingle_set(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def groups(nodes, linked):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}


def brute_force(rows):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets[i] = shingle_set(t)
    ids = sorted(sets)
    linked = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    top = groups(ids, linked)
    return sorted(
        ((i or 0, len(shingle_set(t)), top.get(i), i is None or top[i] == i) for i, t in rows), key=str
    )


def brute_force_by_group(rows):
    """The same where only texts of one thousand of ids can be alike."""
    return [x for group in sorted({i // 1000 for i, _ in rows}) for x in brute_force([r for r in rows if r[0] // 1000 == group])]


def varied(base, k, times):
    """Copies of a text, each with its own few words changed."""
    own = base.split()
    return [" ".join("c%d" % n if (j * 31 + n * 7) % len(own) < k else w for j, w in enumerate(own)) for n in range(times)]


@pytest.mark.parametrize("rows", [edge_texts(), []], ids=["edges", "empty"])
def test_against_brute_force(spark, rows):
    found = minhash.near_duplicates(clashing(documents(spark, rows))).collect()
    assert sorted(((r[0] or 0, *r[1:]) for r in found), key=str) == brute_force(rows)


def test_large_group_of_near_copies(spark):
    base = prose(8, 300)
    rows = [(1000 + n, text) for n, text in enumerate([*varied(base, 4, 60), *varied(base, 9, 60)])]
    rows += [(n, prose(100 + n, 80)) for n in range(40)] + [(5000 + n, base) for n in range(30)]
    found = minhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted(((r[0] or 0, *r[1:]) for r in found), key=str) == brute_force(rows)


def test_what_the_smallest_of_a_band_does_not_link(spark):
    # b and c are alike, a is like neither enough: the second comparison within the band must find them
    base = prose(9, 400).split()
    a = " ".join(base[:330] + prose(10, 70).split())
    b, c = " ".join(base), " ".join(base[:398] + ["x", "y"])
    rows = [(1, a), (2, b), (3, c)]
    found = minhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted(((r[0] or 0, *r[1:]) for r in found), key=str) == brute_force(rows)


def test_short_texts_under_a_foreign_leader(spark):
    # a pair at exactly 0.75 in each group, among texts that share its first words and are not like enough
    rows = []
    for group, n in enumerate([8] * 12 + [12, 16]):
        own = [f"g{group}w{k}" for k in range(n)]
        few = own[: (n - 4) * 3 // 4 + 4]
        texts = [few, own, *([*few, *(f"f{k}x{j}" for j in range(n // 3))] for k in range(400))]
        rows += [(1000 * group + k, " ".join(text)) for k, text in enumerate(texts)]
    found = minhash.near_duplicates(documents(spark, rows)).collect()
    wanted = brute_force_by_group(rows)
    assert sum(component == i - 1 for i, _, component, _ in wanted) == 14
    assert sorted((tuple(r) for r in found), key=str) == sorted(wanted, key=str)


def test_low_bits_of_different_minima_agree_by_chance():
    factors, shifts = minhash._permutations(minhash.LONG_MINIMA)
    drawn = np.random.default_rng(1)
    for _ in range(100):
        whole = drawn.integers(0, 1 << 64, 4, np.uint64)
        left, right = (minhash.packed(minhash.signature(x, factors, shifts), 1) for x in (whole, whole[:3]))
        differing = int(np.bitwise_count((left ^ right).view(np.uint64)).sum())
        assert abs(1 - 2 * differing / minhash.LONG_MINIMA - 0.75) < minhash.LONG_SLACK


def test_one_of_each_group_stays(spark):
    left = minhash.without_near_duplicates(clashing(documents(spark)))
    assert left.columns == clashing(documents(spark)).columns
    wanted = {i for i, _, _, kept in brute_force(edge_texts()) if kept}
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == sorted(wanted)


def test_shingles_are_sets_of_word_runs():
    texts = ["A b\tc D e f", "a B c d e f", "", "a", "a b", "b a", "é É"]
    hashes, bounds = words(texts)
    sets = [shingles(hashes[bounds[k] : bounds[k + 1]]).tolist() for k in range(len(texts))]
    assert sets[0] == sets[1] and [len(s) for s in sets] == [2, 2, 0, 1, 1, 1, 1]
    assert len({tuple(s) for s in sets[2:]}) == 5


def test_components(spark):
    drawn = np.random.default_rng(1)
    chain = [(n, n + 1) for n in range(100, 160)]
    star = [(5000, n) for n in range(6000, 6300)]
    linked = [*chain, *star, *[tuple(x) for x in drawn.integers(0, 90, (60, 2)).tolist()], (7, 7)]
    df = spark.createDataFrame([*linked, (None, 4), (8, None)], "a long, b long")
    nodes = {n for a, b in linked if a != b for n in (a, b)}
    found = {r["node"]: r["component"] for r in components(df).collect()}
    assert found == groups(nodes, [x for x in linked if x[0] != x[1]])
    assert components(df.limit(0)).collect() == []


def brute_vectors(rows):
    usable = {}
    for k, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v is not None and None not in v:
            x = np.array(v, np.float64)
            if np.isfinite(x).all() and x.any():
                usable[k] = x / np.linalg.norm(x / np.abs(x).max()) / np.abs(x).max()
    linked, counts = [], [0] * len(rows)
    for a in usable:
        for b in usable:
            if a != b and rows[a][2] == rows[b][2] and len(usable[a]) == len(usable[b]):
                if usable[a] @ usable[b] >= 0.93:
                    counts[a] += 1
                    linked.append((rows[a][0], rows[b][0]))
    top = groups({i for i, _, _ in rows if i is not None}, linked)
    return sorted(
        ((i or 0, n, top.get(i), i is None or top[i] == i) for (i, _, _), n in zip(rows, counts)), key=str
    )


def vector_rows():
    drawn = np.random.default_rng(3)
    rows = []
    centres = drawn.standard_normal((6, 16))
    for k in range(240):
        spread = 0.02 + 0.4 * drawn.random()
        v = centres[k % 6] + spread * drawn.standard_normal(16)
        rows.append((k, [float(np.float32(x)) for x in v], k % 2))
    rows += [(300 + k, rows[0][1], 0) for k in range(20)]
    rows += [
        (400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] + [1.0] * 15, 1), (403, [None] + [1.0] * 15, 1),
        (404, [float("inf")] * 16, 1), (405, rows[1][1], None), (406, rows[1][1][:8], 1), (407, [], 1), (None, rows[1][1], 1),
        (408, [1e-30] * 16, 1), (409, [1e30] * 16, 1),
    ]
    return rows


def test_vectors_against_brute_force(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for shard_rows in (50, 8192):
        found = embeddings.near_vectors(df, shard_rows=shard_rows).collect()
        assert sorted(((r[0] or 0, *r[1:]) for r in found), key=str) == brute_vectors(rows)
    assert embeddings.near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("same", [False, True])
def test_pairs_count_for_both_ends(same):
    # beams so narrow that a search misses much of what the search from the other end finds
    drawn = np.random.default_rng(8)
    left = drawn.standard_normal((400, 48))
    right = left + 0.25 * drawn.standard_normal(left.shape)
    shards = []
    for k, vectors in enumerate([np.concatenate([left, right])] * 2 if same else [left, right]):
        vectors = embeddings._units(vectors)
        ids = np.arange(len(vectors)) + (0 if same else 1000 * k)
        shards.append((ids, 1 + ids % 3, vectors, Graph.build(vectors).dump(), 2))
    found = []
    for one, two in (shards, shards[::-1]):
        graph = Graph.load(two[2], two[3])
        for i, v in zip(one[0].tolist(), one[2]):
            near, likes = graph.search(v, 2, 0.93 - embeddings.SLACK)
            found.append({(i, int(two[0][j])) for j in near[likes >= 0.93] if two[0][j] != i})
    ways = set().union(*found)
    both = ways | {(b, a) for a, b in ways}
    assert len(ways) < len(both)  # some pairs are found from one end only
    wanted = {a: sum(1 + b % 3 for x, b in both if x == a) for a, _ in both}
    links = embeddings._ask(*shards, same, 0.93)
    assert {int(k): n for k, n in links.groupby("rep")["links"].sum().items() if n} == wanted
    top = groups(wanted, both)
    tied = [(int(a), int(b)) for a, b in zip(links["rep"], links["other"]) if a != b]
    assert groups(wanted, tied) == top


def test_beam_widens_until_the_audit_passes():
    drawn = np.random.default_rng(5)
    vectors = drawn.standard_normal((1500, 24))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = Graph.build(vectors)
    beam = graph.audited_beam(0.93, width=4, near=10)
    truth = np.argsort(-(vectors @ vectors.T), axis=1)[:, :10]
    hits = [len(np.intersect1d(truth[k], graph.search(vectors[k], beam, 2.0)[0])) for k in range(0, 1500, 7)]
    assert beam > 4 and np.mean(hits) >= 9
    again = Graph.load(vectors, graph.dump())
    assert (np.sort(again.search(vectors[3], beam, 0.9)[0]) == np.sort(graph.search(vectors[3], beam, 0.9)[0])).all()


def test_words_that_collide_modulo_a_power_of_two_are_not_linked(spark):
    x, y = colliding_words()
    found = minhash.near_duplicates(documents(spark, [(1, x), (2, y), (3, x)])).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 2), (3, 1)}
