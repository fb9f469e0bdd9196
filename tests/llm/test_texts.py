import hashlib
import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stockledger.llm import chat, fingerprints, language, mixing, urls
from tests.llm.rows import clashing, documents, edge_texts, prose

# --- phrase fingerprints -------------------------------------------------------------------------------


def phrases(text):
    found, begin = set(), 0
    for end in range(1, len(text) + 1):
        if text[begin:end] not in found:
            found.add(text[begin:end])
            begin = end
    return found


@pytest.mark.parametrize("text", ["", "a", "aaaa", "abab" * 50, prose(1, 300), "漢字👍" * 20, "a" * 100 + "b"])
def test_parser_finds_the_phrases(text):
    ends: list[int] = []
    seen: set[str] = set()
    fingerprints.parse(text, 0, seen, len(text), ends)
    assert seen == phrases(text) and len(ends) == len(seen)
    half = len(text) - len(text) // 2
    own, other = fingerprints.both_fingerprints(text, half, text[:half] + "zzz")
    assert (own == fingerprints.fingerprint(text)).all()
    assert (other == fingerprints.fingerprint(text[:half] + "zzz")).all()


def test_likeness_is_near_the_jaccard_of_phrases():
    for seed in range(5):
        a = prose(seed, 900)
        b = a[: len(a) // 2] + prose(seed + 50, 450)
        x, y = phrases(a), phrases(b)
        estimate = fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b))
        assert abs(estimate - len(x & y) / len(x | y)) < 0.15


def check_fingerprints(spark, rows, **more):
    found = fingerprints.fingerprinted(clashing(documents(spark, rows)).repartition(3), **more).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    wanted = []
    for k, (i, text) in enumerate(order):
        text = text or ""
        after = order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 2
        edited = text[: len(text) - cut] + after[:cut]
        marks = [fingerprints.fingerprint(t) for t in (text, edited, after)]
        wanted.append(
            (
                i,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                fingerprints.written_as(marks[0]),
                fingerprints.written_as(marks[1]),
                fingerprints.likeness(marks[0], marks[1]),
                fingerprints.likeness(marks[0], marks[2]),
            )
        )
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


@pytest.mark.parametrize("rows_in_range", [2, 5, 1000])
def test_fingerprints_of_neighbours(spark, rows_in_range):
    rows = [r for r in edge_texts() if r[0] is not None]
    check_fingerprints(spark, rows, rows_in_range=rows_in_range)


def test_fingerprints_of_few(spark):
    check_fingerprints(spark, [])
    check_fingerprints(spark, [(5, "only one")])
    check_fingerprints(spark, [(None, "without an id"), (7, "abc def"), (1 << 62, None), (-(1 << 62), "x" * 50)], rows_in_range=1)


def drawn_texts(seed, n):
    drawn = random.Random(seed)
    for _ in range(n):
        letters = drawn.choice(["a", "ab", "abc", "aé漢👍", "abcdefghij \n", "a\ud800b"])
        yield tuple("".join(drawn.choices(letters, k=drawn.choice([0, 1, 2, 3, 10, 50, 300]))) for _ in range(2))


@pytest.mark.parametrize("tree_chars", [1 << 17, 0])
def test_phrases_of_both_texts(monkeypatch, tree_chars):
    monkeypatch.setattr(fingerprints, "TREE_CHARS", tree_chars)
    for text, after in drawn_texts(1, 300):
        cut = len(text) // 2
        half = len(text) - cut
        edited = text[:half] + after[:cut]
        ends, both, tail, begin = fingerprints.both_phrases(text, half, edited)
        for whole, stops in ((text, [0, *ends]), (edited, [0, *ends[:both], *tail])):
            assert sorted(whole[a:b] for a, b in zip(stops, stops[1:])) == sorted(phrases(whole))
        assert begin == [0, *ends][both] <= half


@pytest.mark.parametrize("chars", [1, 7, 100])
def test_hashes_of_long_texts_in_pieces(monkeypatch, chars):
    texts = [(text, len(text) - len(text) // 2, text[: len(text) - len(text) // 2] + after) for text, after in drawn_texts(4, 60)]
    whole = fingerprints._fingerprints(texts)
    monkeypatch.setattr(fingerprints, "HASHED_CHARS", chars)
    assert all((a == b).all() for a, b in zip(fingerprints._fingerprints(texts), whole))


def test_lengths_that_alternate_take_few_look_ups():
    class Counted(set):
        asked = 0

        def __contains__(self, phrase):
            Counted.asked += 1
            return super().__contains__(phrase)

    # a phrase as long as can be and a phrase of one character in turn: found one character further at a time,
    # each phrase took as many look-ups as it has characters
    text = "".join("a" * k + chr(0x4E00 + k) for k in range(300))
    seen, ends = Counted(), []
    fingerprints.parse(text, 0, seen, len(text), ends)
    assert seen == phrases(text)
    assert Counted.asked < len(text) / 2


@pytest.mark.parametrize("most_rows, most_chars", [(1, 10**6), (2, 10**6), (3, 200), (1000, 10**6)])
def test_groups_of_texts_do_not_show(most_rows, most_chars):
    texts = [text for text, _ in drawn_texts(2, 40)]
    rows = [(0, False, k, text) for k, text in enumerate(texts[:15])] + [(0, True, 15, texts[15]), (0, True, 15, "tied")]
    rows += [(1, False, k, texts[k]) for k in range(15, 39)] + [(1, True, 0, texts[0])]
    rows = [(r, e, k, t.encode("utf-8", "replace").decode()) for r, e, k, t in rows]
    names = ["range", "extra", "doc_id", "text"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[a : a + 7]]) for a in range(0, len(rows), 7)]
    found = [tuple(r.values()) for b in fingerprints.compared(iter(batches), most_rows, most_chars) for r in b.to_pylist()]
    wanted = []
    for (_, extra, k, text), (_, _, _, after) in zip(rows, rows[1:]):
        if extra:
            continue
        cut = len(text) // 2
        edited = text[: len(text) - cut] + after[:cut]
        own, other, following = (fingerprints.fingerprint(t) for t in (text, edited, after))
        marks = fingerprints.written_as(own), fingerprints.written_as(other)
        near = fingerprints.likeness(own, other), fingerprints.likeness(own, following)
        wanted.append((k, len(text), hashlib.sha256(edited.encode()).hexdigest(), *marks, *near))
    assert found == wanted


def test_both_texts_take_less_time_than_slices_of_one():
    """A text and its edited one were parsed by slices of the text: one and a half times as long as one alone."""
    drawn = random.Random(3)
    words = ["".join(drawn.choices("etaoinshrdlu", k=drawn.randint(1, 9))) for _ in range(2000)]
    text, after = (" ".join(drawn.choices(words, k=1500)) for _ in range(2))
    half = len(text) - len(text) // 2
    edited = text[:half] + after[: len(text) // 2]

    def least(function, *of):
        took = []
        for _ in range(15):
            start = time.process_time()
            function(*of)
            took.append(time.process_time() - start)
        return min(took)

    assert least(fingerprints.both_fingerprints, text, half, edited) < 1.2 * least(fingerprints.fingerprint, text)


@pytest.mark.parametrize("rows_in_range", [1, 7, 1000])
def test_many_rows_of_one_id_are_cut_by_their_texts(spark, rows_in_range):
    """They all stood in one range, and each of them was sent to the next one too."""
    texts = [text for text, _ in drawn_texts(6, 150) if text.isascii()]
    rows = [(None if k % 3 else 5, text) for k, text in enumerate(texts)] + [(k, prose(k, 9)) for k in range(20)]
    df = documents(spark, rows).repartition(3)
    # ordered by id and hash, as Spark has it
    ordered = [(r["doc_id"], r["text"]) for r in df.orderBy(F.desc_nulls_last("doc_id"), F.xxhash64("text")).collect()]
    found = fingerprints.fingerprinted(df, rows_in_range).select("doc_id", "n_chars", "edited_sha256", "fingerprint").collect()
    wanted = []
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        cut = len(text) // 2
        edited = text[: len(text) - cut] + after[:cut]
        wanted.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.written_as(fingerprints.fingerprint(text))))
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


def test_ranges_of_few_ids(spark):
    rows = [(None if k % 2 else 5, prose(k, 4)) for k in range(400)]
    bounds, turned, tops = fingerprints._ranges(documents(spark, rows), 10)
    assert len(tops) > 20
    docs = documents(spark, rows).select(fingerprints._order_id().alias("id"), fingerprints._tie().alias("tie")).collect()
    ids, ties = (np.array([row[k] for row in docs], np.int64) for k in (0, 1))
    assert np.bincount(fingerprints._place(bounds, turned, ids, ~ties)).max() < 40


# --- languages -----------------------------------------------------------------------------------------

WORDS = {
    "aa": "the of and that with this from have which their would there been were".split(),
    "bb": "der die und nicht eine auch sich werden haben wurde zwischen durch".split(),
    "cc": "le la les des une dans pour avec cette sont être leur après même".split(),
}


def talk(lang, seed, n):
    drawn = random.Random(seed)
    return " ".join(drawn.choice(WORDS[lang]) for _ in range(n))


def labelled(spark, n=90):
    rows = [(k, talk(lang, k, 30 + k % 50), lang) for k in range(n) for lang in [list(WORDS)[k % 3]]]
    rows += [
        (n + 1, None, "aa"), (n + 2, "", "bb"), (n + 3, "123 -- 456", "cc"), (n + 4, talk("bb", 5, 4000), None),
        (n + 5, talk("cc", 6, 1), None), (None, talk("aa", 7, 30), "bb"), (0, talk("aa", 0, 30), "aa"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def test_languages_are_told_apart(spark):
    df, rows = labelled(spark)
    found = language.identified(clashing(df)).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    for i, text, lang in rows:
        if i is not None and i < 90 and lang:
            assert by_id[i]["lang_pred"] == lang and 0 <= by_id[i]["score"] <= 1
    assert [by_id[90 + k]["lang_pred"] for k in (1, 2, 3, 4)] == ["und", "und", "und", "bb"]
    assert by_id[None]["lang_pred"] == "aa" and by_id[None]["held_out"] is False


def test_held_out_labels_and_order_change_nothing(spark):
    df, _ = labelled(spark)
    lying = df.withColumn("lang", F.when(language.fold() == 0, F.lit("zz")).otherwise(F.col("lang")))
    want = sorted(map(tuple, language.identified(df).collect()), key=str)
    assert sorted(map(tuple, language.identified(lying.repartition(5)).collect()), key=str) == want


def test_nothing_labelled(spark):
    df = documents(spark)
    assert {r["lang_pred"] for r in language.identified(df).collect()} == {"und"}
    assert language.identified(df.limit(0)).collect() == []


def test_automaton_counts_the_longest_matches(monkeypatch):
    text, asked = "abracadabra", "abraXcadXXbrab"
    begin = count = 0
    while begin < len(asked):
        end = begin + 1
        while end <= len(asked) and asked[begin:end] in text:
            end += 1
        begin, count = max(begin + 1, end - 1), count + 1
    points = np.frombuffer(asked.encode("utf-32-le"), "<u4")
    found = language.Automaton(text).phrases(points, np.array([0]), np.array([len(asked)]))
    assert found.tolist() == [count]
    monkeypatch.setattr(language, "STRETCH", 5)
    assert language.predict([talk("aa", 1, 200)], (("aa", talk("aa", 2, 99)), ("bb", talk("bb", 2, 99))))[0][0] == "aa"


# --- URLs ----------------------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://", "https://com", "https://com/", "https://A.Com/x", "ftp://x.net/es/1?q#r", "x://net/es",
    "http://www.Example.com/en/1", "http://example.com/en/", "http://example.com/EN/", "http://b.example.com/en/a?b#c",
    "http://notexample.com/en/", "http://example.com?x=/en/", "http://net/es/", "http://u.v.net/fr/", "http://u.v.net:80/fr/",
    "a://b.com/x://c.net/es/", "http://é.com/ü", "http://x.org/en/#top",
]
RULES = [
    urls.Rule("allow", "com", "/"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/"), urls.Rule("block", "org", "/e"), urls.Rule("block", "é", ""),
]


def judged(url):
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", "", None, "allow"
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:] if rest[cut : cut + 1] == "/" else ""
    for c in "?#":
        path = path.partition(c)[0]
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.text), len(r.host), r.verdict == "block"), default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


@pytest.mark.parametrize("inline", [100, 0])
def test_rules(spark, monkeypatch, inline):
    rows = [(k, u) for k, u in enumerate([*URLS, *URLS[5:9]])]
    df = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, verdict string")
    found = {r["page_id"]: tuple(r)[2:] for r in urls.judge_urls(df, RULES, inline=inline).collect()}
    assert found == {k: judged(u) for k, u in rows}
    monkeypatch.setattr(urls, "BROADCAST_RULES", 0)
    found = {r["page_id"]: tuple(r)[2:] for r in urls.judge_urls(df, RULES, inline=inline).collect()}
    assert found == {k: judged(u) for k, u in rows}
    assert urls.judge_urls(df.limit(0), RULES, inline=inline).collect() == []
    assert {r["verdict"] for r in urls.judge_urls(df, []).collect()} == {"allow"}


@pytest.mark.parametrize("inline", [100, 0])
def test_a_later_mark_is_no_host(spark, inline):
    rows = list(enumerate([
        "http://net?next=http://b.com/es/x", "https://x.com#a://net/es/", "http://net", "http://net?a://", "://net?b://c/d",
        "http://net/es/?next=http://b.com/fr/", "a?b://net/fr/x://y/z", "http://?://net/es/", "http://a.net\n?x://b/fr/",
    ]))
    df = spark.createDataFrame(rows, "page_id long, url string")
    found = {r["page_id"]: tuple(r)[2:] for r in urls.judge_urls(df, RULES, inline=inline).collect()}
    assert found == {k: judged(u) for k, u in rows}


def test_rules_stand_under_their_rarest_token(spark):
    keys = spark.createDataFrame([(["example", "com", "en"],), (["com", "en"],), (["com"],)], "tokens array<string>")
    index = urls.index_rules(keys, RULES[:3])
    assert {t: [r.text for r in some] for t, some in index.items()} == {
        "com": ["com/"], "example": ["example.com/en/"], "www": ["www.example.com/en/"]
    }


def test_urls_are_not_shuffled_for_few_rules(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    plan = urls.judge_urls(df, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


# --- dialogues -----------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def turns(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob b", "hello\nann"), (1, 3, "ann", None),
        (1, 3, "bob b", "tie"), (1, 3, "bob b", "tie"), (2, 0, "system", "alone"), (3, None, None, "late"), (3, 5, "u", "é👍"),
        (None, 1, "u", "no id"),
    ]
    return spark.createDataFrame(rows, TURNS), rows


def rendered(rows):
    found = {}
    by_conv = {}
    for c, n, role, text in rows:
        by_conv.setdefault(c, []).append((1 << 63 if n is None else n, role or "unknown", (text or "").replace("<|", "< |")))
    for conv, own in by_conv.items():
        for speaker in {r for _, r, _ in own} - {"system"}:
            out, spans = "", []
            for _, role, text in sorted(own):
                name = role if role == "system" else "assistant" if role == speaker else "user name=" + role.replace(" ", "_")
                head = f"<|im_start|>{name}\n"
                if role == speaker:
                    spans.append((len(out + head), len(out + head + text) + 10))
                out += f"{head}{text}<|im_end|>\n"
            found[conv, speaker] = (len(own), out, spans)
    return found


def test_every_participant_is_the_assistant_once(spark):
    df, rows = turns(spark)
    wide = df.withColumn("part", F.lit("own")).withColumn("speaker", F.lit("own"))
    found = {
        (r["conv_id"], r["speaker"]): (r["n_turns"], r["text"], [tuple(s) for s in r["spans"]])
        for r in chat.rotate(wide.repartition(4)).collect()
    }
    assert found == rendered(rows)
    assert chat.rotate(df.limit(0)).collect() == []


def test_long_dialogues_go_on_in_parts(spark):
    rows = [(7, n, "ann" if n % 2 else "bob", f"turn {n} " * 5) for n in range(200)] + [(8, 1, "x", "short")]
    df = spark.createDataFrame(rows, TURNS)
    found = chat.rotate(df, part_chars=500).orderBy("conv_id", "speaker", "part").collect()
    whole = rendered(rows)
    for (conv, speaker), (n, text, spans) in whole.items():
        own = [r for r in found if (r["conv_id"], r["speaker"]) == (conv, speaker)]
        assert "".join(r["text"] for r in own) == text and sum(r["n_turns"] for r in own) == n
        assert [r["text"][a:b] for r in own for a, b in r["spans"]] == [text[a:b] for a, b in spans]
        assert all(len(r["text"]) < 500 + 100 for r in own)


# --- mixtures ------------------------------------------------------------------------------------------


def corpus(spark, n=400):
    kinds = {"good": "fine clear prose about nature", "poor": "buy cheap now click here", "toxic": "vile hateful slur abuse"}
    names = list(kinds)
    rows, known = [], []
    for k in range(n):
        drawn = random.Random(k)
        domain = names[0 if k % 10 < 7 else 1 if k % 10 < 9 else 2]
        rows.append((k, " ".join(drawn.choice(kinds[domain].split() + ["a", "b", "c"]) for _ in range(20 + k % 30))))
        if k % 2:
            known.append((k, domain))
    rows += [(n, None), (n + 1, ""), (n + 2, "a b c"), (0, rows[0][1]), (None, "no id")]
    return documents(spark, rows), spark.createDataFrame([*known, (None, "good"), (5, "nonsense")], "doc_id long, domain string")


def test_expected_tokens_meet_the_targets(spark):
    docs, known = corpus(spark)
    targets = {"good": 0.6, "poor": 0.35, "toxic": 0.05}
    mixed = mixing.mix(clashing(docs), known, targets, 1.5).collect()
    total = sum(r["n_tokens"] for r in mixed)
    for k, (_, weight) in enumerate(targets.items()):
        got = sum(r["rate"] * r["n_tokens"] * r["posteriors"][k] for r in mixed)
        assert abs(got - 1.5 * total * weight) <= 2e-4 * 1.5 * total
    assert all(r["rate"] >= 0 and r["copies"] in (math.floor(r["rate"]), math.floor(r["rate"]) + 1) for r in mixed)
    assert all(abs(sum(r["posteriors"]) - 1) < 1e-6 for r in mixed)
    twice = [tuple(r) for r in mixed if r["doc_id"] == 0]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_domains_are_learned(spark):
    docs, known = corpus(spark)
    classifier = mixing.fit_domains(docs, known, ["good", "poor", "toxic"])
    shares, counts = classifier.posteriors(["clear nature prose", "click cheap now", "slur abuse vile", ""])
    assert shares[:3].argmax(axis=1).tolist() == [0, 1, 2] and counts.tolist() == [3, 3, 3, 0]


def test_out_of_reach_targets_stay_nonnegative(spark):
    docs, known = corpus(spark)
    with pytest.warns(UserWarning, match="can't meet"):
        mixed = mixing.mix(docs, known, {"good": 0.0, "poor": 0.0, "toxic": 1.0}).collect()
    rates = [r["rate"] for r in mixed]
    assert min(rates) == 0 and max(rates) > 1 and {r["miss"] for r in mixed} == {mixed[0]["miss"]}


def nearest(shares, tokens, targets, steps=60_000):
    """The totals of the nonnegative least squares, by accelerated descent."""
    a = shares * tokens[:, None] / tokens.sum()
    t = targets / tokens.sum()
    bound = np.linalg.norm(a.T @ a, 2)
    rate = before = np.ones(len(a))
    for k in range(steps):
        ahead = rate + k / (k + 3) * (rate - before)
        before, rate = rate, np.maximum(0, ahead - a @ (ahead @ a - t) / bound)
    return rate @ a * tokens.sum()


@pytest.mark.parametrize("targets", [(0.84, 0.14, 0.02), (0.2, 0.2, 0.6), (0.0, 0.0, 1.0), (0.97, 0.0, 0.03), (1 / 3, 1 / 3, 1 / 3)])
def test_totals_are_those_of_the_nonnegative_least_squares(spark, targets):
    drawn = np.random.default_rng(5)
    shares = drawn.dirichlet([0.8, 0.4, 0.15], 300) * 0.9 + np.array([0.06, 0.03, 0.01])
    tokens = drawn.integers(1, 400, 300).astype(float)
    table = spark.createDataFrame(
        [(int(n), p.tolist()) for n, p in zip(tokens, shares, strict=True)], "n_tokens long, posteriors array<double>"
    )
    wanted = np.array(targets) * 1.25 * tokens.sum()
    calls, real = [], mixing._sums
    mixing._sums = lambda *args: calls.append(1) or real(*args)
    try:
        shift, totals = mixing.fit_rates(table, wanted)
    finally:
        mixing._sums = real
    best = nearest(shares, tokens, wanted)
    assert np.abs(totals - best).max() <= 2e-3 * wanted.sum()
    assert np.linalg.norm(totals - wanted) <= np.linalg.norm(best - wanted) + 2e-4 * wanted.sum()
    assert np.allclose((mixing.rates(shares, shift) * tokens) @ shares, totals)
    assert len(calls) <= 30


def test_mixture_of_nothing(spark):
    docs, known = corpus(spark)
    targets = {"good": 0.5, "poor": 0.5}
    assert mixing.mix(docs.limit(0), known, targets).collect() == []
    alone = mixing.mix(docs, known.limit(0), targets).collect()
    assert all(abs(r["rate"] - 1) < 1e-3 and abs(r["posteriors"][0] - 0.5) < 1e-9 for r in alone)
