"""Hand-made documents with what operators must bear."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, words: int = 400) -> str:
    drawn = random.Random(seed)
    return " ".join("w%x" % drawn.randrange(words) for _ in range(n))


def edge_texts() -> list[tuple[int | None, str | None]]:
    """Null and empty texts and ids, blanks, copies, near copies, ties, repeated rows, a long text."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    long = prose(2, 30_000, 5000)
    return [
        (1, base),
        (2, base),
        (3, " ".join(near)),
        (4, None),
        (5, ""),
        (6, "  \n\t \n"),
        (7, "Ein Wort"),
        (8, "ein wort"),
        (9, prose(3, 50)),
        (9, prose(3, 50)),
        (10, long),
        (11, long + " more"),
        (None, prose(4, 40)),
        (12, "é à 漢字 👍🏽 <|endoftext|>  x"),
        (13, "a b c d"),
        (14, "a b c d e"),
        (15, "a b c d e f"),
        (-3, prose(5, 60) + "\n" + base),
    ]


def documents(spark, rows=None):
    rows = edge_texts() if rows is None else rows
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in rows], DOCS)


def clashing(df):
    """The documents with more columns, under names that operators use."""
    from pyspark.sql import functions as F

    names = ["part", "rep", "score", "ids", "curve", "copies", "rate", "range", "gone", "row", "left", "id", "k"]
    return df.select("*", *(F.lit(f"own {n}").alias(n) for n in names))


def colliding_words() -> tuple[str, str]:
    """Two words that every polynomial hash modulo 2**64 with an odd base confuses, whatever its letters' codes."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))
