import random
import re
import time

import pytest
from pyspark.sql import functions as F

from stockledger.llm import lines
from stockledger.llm.scratch import CLEANUP, written
from tests.llm.rows import clashing, documents, edge_texts, prose

def word_set(line):
    return frozenset(re.findall(r"[^\x20\x09-\x0D]+", line.lower()))


def decided(rows):
    """By id and line number: distinct words, and whether no line before it matches."""
    seen, found = [], {}
    for i, text in sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        for n, line in enumerate(text.split("\n")):
            own = word_set(line)
            if own:
                matched = any(100 * len(own & other) >= 75 * len(own | other) for other in seen)
                found[i, n] = (len(own), not matched)
                seen.append(own)
    return found


def checked(spark, rows):
    found = lines.line_decisions(clashing(documents(spark, rows)).repartition(3)).collect()
    assert {(r["doc_id"], r["line_no"]): (r["n_words"], r["kept"]) for r in found} == decided(rows)
    return found


def test_edge_rows(spark):
    rows = edge_texts()
    found = checked(spark, rows)
    assert sum(r["doc_id"] == 9 for r in found) == 2  # rows that are repeated get the same decisions
    checked(spark, [])


def test_variants_of_lines(spark):
    drawn = random.Random(4)
    common = [prose(k, drawn.randrange(3, 40)).split() for k in range(30)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(8):
            own = list(drawn.choice(common))
            for _ in range(drawn.choice([0, 0, 1, 2, 4])):
                own[drawn.randrange(len(own))] = "v%d" % drawn.randrange(50)
            text.append(" ".join(own).title() if drawn.random() < 0.2 else "  ".join(own))
        rows.append((i, "\n".join(text)))
    checked(spark, rows)


def test_few_common_words(spark):
    # no rare token to tell lines apart by, and a large group of near copies
    drawn = random.Random(6)
    words = list("abcdefghijkl")
    rows = [(i, "\n".join(" ".join(drawn.sample(words, drawn.randrange(1, 12))) for _ in range(6))) for i in range(80)]
    checked(spark, rows)


def test_lines_of_very_many_words(spark):
    long, other = ([f"{c}{k}" for k in range(n)] for c, n in (("a", 40_000), ("b", 140_000)))
    checked(spark, [(1, " ".join(long)), (2, " ".join([*long[:-9], "new"])), (3, " ".join(other))])


def changed_lines(drawn, words, most):
    """Lines of ``words`` and variants of them, with as many words taken, put in or changed as may keep them alike."""
    rows = []
    for i in range(50):
        base = drawn.sample(words, drawn.randrange(1, most))
        text = [base]
        for _ in range(4):
            own = list(base)
            for _ in range(drawn.randrange(len(base) // 3 + 2)):
                how = drawn.randrange(3)
                if how and len(own) > 1:
                    own.pop(drawn.randrange(len(own)))
                if how < 2:
                    own.insert(drawn.randrange(len(own) + 1), drawn.choice(words))
            text.append(own)
        rows.append((i, "\n".join(" ".join(line) for line in text)))
    return rows


@pytest.mark.parametrize("rare", [0, 5, lines.RARE])
def test_keys_of_one_and_two_tokens(spark, monkeypatch, rare):
    # words of any frequency: all lines alike are found by the keys, whatever counts as rare
    monkeypatch.setattr(lines, "RARE", rare)
    drawn = random.Random(11 + rare)
    words = [f"w{int(k**1.5)}" for k in range(90)]
    found = checked(spark, changed_lines(drawn, words, 40))
    assert sum(r["near"] for r in found) > 20


def test_unlike_lines_of_many_common_words_are_not_compared(spark, monkeypatch):
    drawn = random.Random(8)
    words = [f"w{k}" for k in range(1500)]
    rows = [(i, " ".join(drawn.sample(words, 120))) for i in range(400)]
    compared = []

    def counted(df, name, *more):
        table = written(df, name, *more)
        compared.extend([table.count()] if name in ("line-pairs", "line-candidates") else [])
        return table

    monkeypatch.setattr(lines, "written", counted)
    checked(spark, rows)
    assert sum(compared) < len(rows)


def test_only_lines_in_question_are_split_again(spark, monkeypatch):
    split = []
    tokenized = lines._tokenized

    def counted(rows, classes, kept):
        split.append(rows.count())
        return tokenized(rows, classes, kept)

    monkeypatch.setattr(lines, "_tokenized", counted)
    other = [prose(k, 12) for k in range(40)]
    rows = [(1, "\n".join(["one two three four five", *other])), (2, "one two three four five six")]
    checked(spark, rows)
    assert split[0] == 42 and 0 < sum(split[1:]) < 10


def test_documents_without_their_repeated_lines(spark):
    rows = [
        (1, "one two three four\n\nfive six seven eight"),
        (2, "new words stand here\none two three four\nlast line of two"),
        (3, "five six seven eight\nONE two three FOUR"),
        (4, None),
        (5, ""),
        (6, " \n"),
        (1, "one two three four\n\nfive six seven eight"),
    ]
    df = clashing(documents(spark, rows))
    left = lines.dedup_lines(df)
    assert left.columns == df.columns
    found = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in left.collect()), key=str)
    wanted = [rows[0], (2, "new words stand here\nlast line of two"), *rows[3:]]
    assert found == sorted(((i, t, None if t is None else len(t)) for i, t in wanted), key=str)


def test_shuffles_of_written_tables_leave_no_files(spark):
    held = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        blocks = held.getAllBlocks()
        names = {str(blocks.apply(k)) for k in range(blocks.size())}
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffled()
    counts = written(spark.range(5000).groupBy((F.col("id") % 50).alias("k")).count(), "counts")
    assert counts.agg(F.sum("count")).first()[0] == 5000 and spark.conf.getAll.get(CLEANUP) is None
    # that of the sum may stay; files go in the background
    left = lambda: {name.split("_")[1] for name in shuffled() - before}
    until = time.monotonic() + 20
    while len(left()) > 1 and time.monotonic() < until:
        time.sleep(0.2)
    assert len(left()) <= 1


def test_the_plan_has_no_python(spark):
    plan = lines.dedup_lines(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
