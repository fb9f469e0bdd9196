import re
from collections import Counter

import numpy as np
import pytest

from stockledger.llm import repetition
from tests.llm.rows import clashing, documents, edge_texts, prose

NGRAMS = tuple(repetition.MOST_IN_NGRAMS)


def figures(text, lengths=NGRAMS):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": 0,
        "dup_line_chars": 0,
    }
    seen = set()
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            if line in seen:
                found["n_dup_lines"] += 1
                found["dup_line_chars"] += len(re.sub(r"[\x20\x09-\x0D]", "", line))
            seen.add(line)

    def inside(n, first):
        grams = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]
        count, held, covered = Counter(grams), set(), set()
        for k, gram in enumerate(grams):
            if (count[gram] > 1 if first else gram in held):
                covered |= set(range(k, k + n))
            held.add(gram)
        return covered

    found["n_repeat_words"] = len(inside(3, True))
    for n in lengths:
        found[f"in_{n}_grams"] = sum(len(words[k]) for k in inside(n, False))
    return found


def some_texts():
    line = prose(7, 12)
    return [
        *(text for _, text in edge_texts()),
        "a a a a a a a a a a a a",
        f"{line}\n{line}\n{prose(8, 60)}\n {line}\n{line}",
        "é 漢字 👍 é 漢字 👍 é 漢字 👍\x1c\x85 é|<>#",
        "x " * 60 + prose(9, 60),
        " ".join([prose(10, 30)] * 3),
        "\n\n \n",
        "  one two\x0bthree\x0cfour\rfive",
    ]


def whole(texts, lengths=NGRAMS):
    raw = [(text or "").encode() for text in texts]
    found = repetition.measures(raw, lengths)
    return [{name: int(found[name][k]) for name in found} for k in range(len(raw))]


def test_figures_are_those_of_a_plain_count():
    texts = some_texts()
    assert whole(texts) == [figures(text) for text in texts]
    assert whole([]) == []


def test_windows_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(repetition, "PRIMES", (3, 5))
    texts = [t for t in some_texts() if not t or len(t) < 5000]
    assert whole(texts) == [figures(text) for text in texts]


def test_texts_in_one_slice_do_not_mix():
    text = prose(11, 40)
    assert whole([text, text])[1] == figures(text)
    assert repetition.measures([text.encode()] * 2, NGRAMS)["n_repeat_words"].sum() == 0


def judged_plainly(text):
    f = figures(text)
    failed = f["n_words"] < 50 or 100 * f["n_repeat_words"] > 50 * f["n_words"]
    much = 100 * f["dup_line_chars"] > 20 * f["word_chars"] or any(
        100 * f[f"in_{n}_grams"] > most * f["word_chars"] for n, most in repetition.MOST_IN_NGRAMS.items()
    )
    return failed, not failed and not much


def test_every_row_is_judged(spark):
    long = prose(12, 150_000, 60_000)
    rows = [*enumerate(some_texts()), (3, prose(1, 80)), (3, prose(1, 80)), (None, None), (99, long)]
    found = repetition.judged(clashing(documents(spark, rows)).repartition(3)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    wanted = [(i, *(figures(t)[n] for n in names), *judged_plainly(t)) for i, t in rows]
    assert Counter((r.doc_id, *(r[n] for n in names), r.base_failed, r.kept) for r in found) == Counter(wanted)
    assert {r.kept for r in found if r.doc_id == 99} == {True}


def test_slices_do_not_matter(spark):
    rows = list(enumerate(some_texts()))
    small = repetition.repetition(documents(spark, rows).coalesce(1), slice_bytes=1)
    large = repetition.repetition(documents(spark, rows).coalesce(1))
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_no_rows(spark):
    assert repetition.judged(documents(spark, [])).collect() == []


@pytest.mark.parametrize("share, kept", [(5, True), (40, False)])
def test_verdict_follows_the_repeated_share(spark, share, kept):
    passage = prose(20, 12, 10_000)
    text = " ".join([passage] * 2 + [prose(21, 12 * 100 // share, 10_000)])
    assert repetition.judged(documents(spark, [(1, text)])).first().kept is kept


def test_prime_products_fit():
    assert max(repetition.PRIMES) ** 2 + max(repetition.PRIMES) < np.iinfo(np.uint64).max
    assert all(0 < b < p for b, p in zip(repetition.BASES, repetition.PRIMES, strict=True))
