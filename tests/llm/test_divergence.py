import random
import re
from collections import Counter

import numpy as np
import pytest

from stockledger.llm import divergence, transducer
from tests.llm.rows import DOCS, clashing

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def places(machine, words):
    classes = transducer.FOLDED[np.frombuffer(b" ".join(words) + b" ", np.uint8)]
    starts = np.cumsum([0, *(len(w) + 1 for w in words)])[:-1]
    return machine.places(classes, starts, np.full(len(words), machine.roots[0])).tolist()


def words_of(seed, n, letters="abcxyzéß漢"):
    r = random.Random(seed)
    return sorted({"".join(r.choice(letters) for _ in range(r.randrange(1, 9))).encode() for _ in range(n)})


@pytest.mark.parametrize("seed", range(4))
def test_places_are_those_in_order(seed):
    terms = words_of(seed, 800)
    machine = transducer.built(terms)
    assert places(machine, terms) == list(range(len(terms)))
    others = [w for w in words_of(seed + 50, 800) if w not in set(terms)] + [t + b"q" for t in terms[:50]]
    assert set(places(machine, others)) == {-1}
    again = transducer.Transducer.unpacked(machine.packed())
    assert places(again, terms) == list(range(len(terms)))


def test_upper_case_finds_the_lower_one():
    assert places(transducer.built([b"ab", "é".encode()]), [b"AB", "É".encode()]) == [0, -1]


@pytest.mark.parametrize("seed", range(3))
def test_states_are_as_few_as_can_be(seed):
    terms = words_of(seed, 200, "ab")
    ends = {frozenset(t[len(p) :] for t in terms if t.startswith(p)) for w in terms for k in range(len(w) + 1) for p in [w[:k]]}
    assert len(transducer.built(terms).final) == len(ends)


def test_terms_must_rise():
    for wrong in ([b"b", b"a"], [b"a", b"a"], [b""], [b"a-b"]):
        with pytest.raises(ValueError):
            transducer.built(wrong)


def audited(rows, least):
    rows = [tuple("" if v is None else v for v in (lang, source, text)) for lang, source, text in rows]
    terms = [(lang, source, TERM.findall(text.translate(LOWER))) for lang, source, text in rows]
    docs, occurs = Counter(), Counter()
    for lang, _, found in terms:
        docs.update((lang, t) for t in set(found))
    kept = {}
    for (lang, term), n in docs.items():
        if n >= least:
            kept.setdefault(lang, []).append(term)
    for lang, source, found in terms:
        occurs.update((lang, source, t) for t in found if docs[lang, t] >= least)
    groups = sorted({(lang, source) for lang, source, _ in terms})
    result = set()

    def shares(counts):
        n, v = sum(counts.values()), len(counts)
        return {t: 1 + 10**9 * (c + 5) // (n + 5 * v) for t, c in counts.items()}

    for lang, source in groups:
        own_terms = kept.get(lang, [])
        of = {s: {t: occurs[lang, s, t] for t in own_terms} for g, s in groups if g == lang}
        p = shares(of[source])
        q = shares({t: sum(counts[t] for counts in of.values()) for t in own_terms})
        pairs = [(s, sum(abs(p[t] - x) for t, x in shares(of[s]).items())) for s in of if s != source]
        stands = [(t, p[t] - q[t]) for t in own_terms if of[source][t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", stands, 50)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            result |= {(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(items[:most])}
    return result


def drawn(seed, n):
    r = random.Random(seed)
    stems = ["the", "Of", "aaaaaaaab", "aaaaaaaac", "aaaaaaaad", "aaaaaaaaé", "und", "É", "x1y", "don't", "漢字", "zz-zz"]
    stems += [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(90)]
    rows = []
    for _ in range(n):
        lang = r.choice(["en", "en", "de", None])
        words = [r.choice(stems[: r.randrange(5, len(stems))]) for _ in range(r.randrange(40))]
        rows.append((lang, r.choice(["s1", "s2", "S", "é", None, ""]), " ".join(words)))
    return rows + [("fr", "only", "rare words"), ("it", "a", None), ("it", "b", ""), ("en", "none", "-- 12 --")]


def docs(spark, rows):
    return spark.createDataFrame([(k // 2, t, lang, s, 0) for k, (lang, s, t) in enumerate(rows)], DOCS)


@pytest.mark.parametrize("more", [{}, {"shard_terms": 3}, {"shard_terms": 40, "pass_bytes": 1}])
def test_against_plain_counting(spark, more):
    rows = drawn(1, 400)
    found = divergence.audit(clashing(docs(spark, rows)).repartition(4), least=5, **more).collect()
    assert {tuple(r) for r in found} == audited(rows, 5) and len(found) == len(audited(rows, 5))


def test_blocks_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 4)
    rows = drawn(2, 300)
    assert {tuple(r) for r in divergence.audit(docs(spark, rows), least=3).collect()} == audited(rows, 3)


def test_counts_that_are_handed_on_early_add_up(spark):
    rows = drawn(3, 200)
    texts = divergence.texts_of(docs(spark, rows)).coalesce(1)
    terms = divergence.vocabulary(divergence.document_counts(texts, held=10), 2)
    whole = divergence.vocabulary(divergence.document_counts(texts), 2)
    assert sorted(map(tuple, terms.collect())) == sorted(map(tuple, whole.collect()))
    held = [(r.lang, r.shard, r["first"], bytes(r.data)) for r in divergence.shards_of(terms).collect()]
    sums = []
    for bound in (1, 1 << 20):
        counted = divergence.recounted(texts, held, divergence.SHARD_TERMS, bound)
        sums.append(sorted(map(tuple, counted.groupBy("lang", "source", "ordinal").sum("n").collect())))
    assert sums[0] == sums[1] != []


def test_a_very_long_text_and_a_very_long_term(spark):
    rows = [("en", "a", "Long" * 50_000 + " " + "to be or not " * 20_000), ("en", "b", "long" * 50_000 + " to")]
    found = divergence.audit(docs(spark, rows), least=2).collect()
    assert {tuple(r) for r in found} == audited(rows, 2)


def test_no_rows(spark):
    assert divergence.audit(docs(spark, [])).collect() == []
