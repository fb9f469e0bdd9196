"""Lines that repeat, found by an exact set-similarity join of their words, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.llm.scratch import written

BLANKS = r"[\x20\x09-\x0D]+"
#: Counters that the words are hashed to for their rarity: 1 MB, whatever the corpus.
COUNTERS = 1 << 20
#: Bits of a token that hold its hash; those above hold its rarity.
HASH_BITS = 57
#: Rarity classes below this are rare (a count under 23): such a token is a signature alone, others go by twos.
RARE = 9
#: Least percentage of likeness at which lines alike always have two neighbouring tokens in common.
BY_TWOS = 75
#: Keys by which a line is first held against the earliest line that has one of them among its own. Those of rare
#: tokens are left out: what a large group of near copies has in common is not rare.
FIRST = 6
#: Columns of the parities of a line's tokens.
BITS = ["even", "odd"]
#: Lines that may be broadcast by their numbers or places (some 20 bytes each); more are joined by shuffles.
BROADCAST_LINES = 1_000_000
#: Passes at most in which pairs are held against each other's sets.
PASSES = 16
#: Passes in which lines meet by their keys: the shuffle of all keys takes more room than the lines' table.
KEY_PASSES = 4


def _trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))


def _words(text: Column) -> Column:
    """The words of a text that has some, in lower case; none of them is empty."""
    return F.split(_trimmed(text), BLANKS)


def rarity(docs: DataFrame) -> DataFrame:
    """One row: the rarity class of each counter, which grows with the logarithm of its count, 0 to 63.

    All words of all texts count. COUNTERS numbers at most reach the driver.
    """
    spark = docs.sparkSession
    counts = (
        docs.select(F.explode(F.split(F.lower("text"), BLANKS)).alias("word"))
        .groupBy(F.pmod(F.xxhash64("word"), F.lit(COUNTERS)).cast("int").alias("counter"))
        .agg(F.count("*").alias("n"))
        .select("counter", F.least(F.lit(63), F.floor(F.log2("n") * 2)).cast("int").alias("class"))
        .toArrow()
    )
    classes = bytearray(COUNTERS)
    for counter, value in zip(counts.column("counter").to_pylist(), counts.column("class").to_pylist()):
        classes[counter] = value
    return spark.createDataFrame([(list(classes),)], "classes array<tinyint>")


def _prefix(tokens: Column, percent: int) -> Column:
    """The length of the prefix of which lines that are alike share a token."""
    return F.size(tokens) - F.ceil(F.size(tokens) * percent / F.lit(100)).cast("int") + 1


def _rare(tokens: Column, percent: int) -> Column:
    """How many tokens of the prefix are rare: as many keys stand for one token, the others for two."""
    if percent < BY_TWOS:
        return F.lit(0)
    head = F.slice(tokens, F.lit(1), _prefix(tokens, percent))
    return F.size(F.filter(head, lambda t: t < F.lit(RARE << HASH_BITS)))


def _signatures(tokens: Column, percent: int) -> Column:
    """32-bit keys of the tokens from the rarest on, of which two lines that are alike share at least one.

    A rare token of the prefix is a key alone. Lines that share no rare token differ in all that they have, r
    here; the others then hold two tokens that are neighbours in both lines, since differing tokens part fewer
    neighbours than there are. The first such two begin at place 1 + 2n(1 - percent / 100) - r at the latest. Keys
    of two tokens stay rare in a large corpus, where a single token of the prefix does not. Other keys that
    share a number are told apart by the filters.
    """
    n = F.size(tokens)
    prefix = _prefix(tokens, percent)
    if percent < BY_TWOS:
        return F.transform(F.slice(tokens, F.lit(1), prefix), lambda t: F.hash(t))
    limit = F.lit(RARE << HASH_BITS)
    rare = _rare(tokens, percent)
    last = F.least(n - 1, F.floor(n * (2 * (100 - percent)) / F.lit(100)).cast("int") + 1 - rare)
    length = F.when(rare >= prefix, prefix).otherwise(F.greatest(rare, last))
    return F.transform(
        F.slice(tokens, F.lit(1), length),
        lambda t, k: F.when(t < limit, F.hash(t)).otherwise(F.hash(t, F.get(tokens, k + 1))),
    )


def _tokens(line: Column, classes: Column) -> Column:
    """A line's distinct words as integers, the rarest first: rarity class above, hash below."""

    def token(word: Column) -> Column:
        hashed = F.xxhash64(word)
        rank = F.get(classes, F.pmod(hashed, F.lit(COUNTERS)).cast("int")).cast("long")
        return F.shiftleft(rank, HASH_BITS).bitwiseOR(hashed.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))

    return F.sort_array(F.array_distinct(F.transform(_words(line), token)))


def _document(doc_id: str = "doc_id") -> list[Column]:
    """What tells documents apart and orders them: the id, null first, and a hash of the text."""
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("doc"),
        F.xxhash64("text").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("version"),
    ]


def _lines(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``doc_id, doc, version, line_no, tokens`` of every line that has a word."""
    rows = docs.select(
        "doc_id", *_document(), F.posexplode(F.split(F.lower("text"), "\n")).alias("line_no", "line")
    ).where(_trimmed(F.col("line")) != "")
    return _tokenized(rows, classes, ["doc_id", "doc", "version", "line_no"])


def _tokenized(rows: DataFrame, classes: DataFrame, kept: list[str]) -> DataFrame:
    """The columns ``kept`` and the ``tokens`` of each ``line``."""
    # the tokens come out of a generator, which is not folded into what uses them more than once; the outer
    # form, since the plain one is preceded by a filter that makes them again
    return (
        rows.withColumn("classes", classes.scalar())
        .select(*kept, F.array(_tokens(F.col("line"), F.col("classes"))).alias("t"))
        .select(*kept, F.explode_outer("t").alias("tokens"))
    )


def _parities() -> list[Column]:
    """Whether an even or an odd number of ``tokens`` falls on each of 128 places, in two numbers."""
    one = "aggregate(tokens, 0L, (acc, t) -> if(t & 64L {} 0L, acc ^ shiftleft(1L, cast(t & 63L as int)), acc))"
    return [F.expr(one.format(sign)).alias(name) for sign, name in zip(("=", "<>"), BITS)]


def _spot() -> Column:
    """The version of a document and the line in one number, which orders lines as they do."""
    return F.shiftleft(F.col("version").cast("long"), 32).bitwiseOR(F.col("line_no").cast("long"))


def _shares(percent: int) -> Column:
    """The fewest tokens that lines of ``x.n`` and ``y.n`` share if they are alike enough."""
    return F.ceil((F.col("x.n") + F.col("y.n")) * F.lit(percent) / F.lit(100 + percent))


def _may_match(percent: int) -> Column:
    """The filters by length, parities and position for two entries of one key."""
    least = _shares(percent)
    n = F.col("x.n") + F.col("y.n")
    behind = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    # a token that only one line has turns one parity, so no more of them differ than there are such tokens
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"x.{k}").bitwiseXOR(F.col(f"y.{k}"))) for k in BITS])
    return (
        (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent)
        & (differ <= n - least * 2)
        & (F.least("x.pos", "y.pos") + behind >= least)
    )


def _later(docs: DataFrame, classes: DataFrame, seen: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """``id`` of the later class, the ``other``, of those pairs whose token sets are alike by ``percent`` of a hundred.

    Only the first lines of the classes in question are split into words again.
    """
    ids = pairs.select("id").union(pairs.select("other")).distinct()
    wanted = written(seen.select("id", "doc", "spot").join(ids, "id", "left_semi"), "line-places")
    by = wanted.groupBy("doc", F.shiftright("spot", 32).cast("int").alias("version")).agg(
        F.collect_list(F.struct("id", F.col("spot").bitwiseAND(F.lit((1 << 32) - 1)).alias("line_no"))).alias("wanted")
    )
    chosen = docs.select("text", *_document()).join(
        F.broadcast(by) if wanted.count() <= BROADCAST_LINES else by, ["doc", "version"]
    )
    lines = chosen.select("wanted", F.posexplode(F.split(F.lower("text"), "\n")).alias("at", "line"))
    lines = lines.select("line", F.explode(F.filter("wanted", lambda w: w["line_no"] == F.col("at"))).alias("w"))
    found = _tokenized(lines.select("line", "w.*"), classes, ["id"])
    # a document that is repeated gives its sets again
    sets = found.groupBy("id").agg(F.first("tokens").alias("tokens"))
    sets = written(sets, "line-sets")
    common = F.size(F.array_intersect("tokens", "other_tokens"))
    # pairs carry a set to the next shuffle, so they go in passes of about as many as there are sets
    passes = max(1, min(PASSES, round(pairs.count() / max(1, sets.count()))))

    def alike(k: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.lit(passes)) == k
        other = sets.toDF("other", "other_tokens")
        return (
            pairs.where(mine)
            .join(sets.where(mine), "id")
            .join(other, "other")
            .select(
                F.col("other").alias("id"),
                common.alias("common"),
                (F.size("tokens") + F.size("other_tokens")).alias("both"),
            )
            .where(F.col("common") * 100 >= (F.col("both") - F.col("common")) * percent)
            .select("id")
            .distinct()
        )

    return reduce(DataFrame.union, [written(alike(k), "line-alike") for k in range(passes)]).distinct()


def line_decisions(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row for each line that has a word: where it stands, ``n_words`` (distinct), ``kept``, and ``near``.

    Two lines match when their sets of distinct words in lower case have a Jaccard similarity of ``percent`` of
    a hundred; sets are told apart by 57-bit hashes of words and 128-bit hashes of sets. A line goes if any
    line before it matches, whether that one stays or not; lines stand by ``doc_id`` (null first), a hash of
    the text (``version``), and place. ``near`` tells whether a line of other words caused it. Lines without a
    word are no rows. Rows that repeat a document and its text are one document and get the same decisions.
    Null texts have no lines; no rows give no rows.

    Lines of one set are a class: only the first can stay. Classes are joined by the keys of their prefix,
    the rarest first, with filters by length, place in the prefix and parities of the sets. A class is
    first held against the earliest class under each of a few keys; one that matches is settled. Only the rest
    meets all earlier classes of its keys, so a large group of near copies is not paired up.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    classes = written(rarity(docs), "rarity")
    n = F.size("tokens")
    occurrences = written(
        _lines(docs, classes).select(
            "doc_id",
            "doc",
            "version",
            "line_no",
            n.alias("n_words"),
            F.xxhash64("tokens").alias("id1"),
            F.xxhash64("tokens", F.lit(1)).alias("id2"),
            _signatures(F.col("tokens"), percent).alias("prefix"),
            _rare(F.col("tokens"), percent).alias("rare"),
            *_parities(),
        ),
        "lines",
    )
    same = ["id1", "id2"]
    seen = (
        occurrences.groupBy(*same)
        .agg(
            F.min(F.struct("doc", _spot().alias("spot"))).alias("place"),
            F.first("n_words").alias("n"),
            F.first("prefix").alias("prefix"),
            F.first("rare").alias("rare"),
            *[F.first(k).alias(k) for k in BITS],
        )
        .select(*same, "place.*", "n", "prefix", "rare", *BITS)
        # numbers are short in a shuffle and stand as the lines do; writing the table fixes them
        .orderBy("doc", "spot")
        .withColumn("id", F.monotonically_increasing_id())
    )
    seen = written(seen, "line-classes")
    first_pairs = written(_first_pairs(seen, percent), "line-pairs")
    settled = written(_later(docs, classes, seen, first_pairs, percent), "line-settled")
    rest = written(_other_pairs(seen, settled, percent), "line-pairs")
    gone = settled.union(_later(docs, classes, seen, rest, percent)).distinct().withColumn("near", F.lit(True))
    decided = seen.select(*same, "id", "doc", "spot").join(gone, "id", "left")
    first = (F.col("doc") == F.col("first_doc")) & (_spot() == F.col("first_spot"))
    return (
        occurrences.drop("prefix", "rare", *BITS)
        .join(
            decided.select(
                *same,
                F.col("doc").alias("first_doc"),
                F.col("spot").alias("first_spot"),
                F.coalesce("near", F.lit(False)).alias("near"),
            ),
            same,
        )
        .select("doc_id", "version", "line_no", "n_words", (~F.col("near") & first).alias("kept"), "near")
    )


def _first_pairs(seen: DataFrame, percent: int) -> DataFrame:
    """Each class with the earliest of those that share one of its first keys of two tokens, where they may match."""
    entry = ["doc", "spot", "id", "n", "pos", *BITS]
    rarest = seen.select(
        F.posexplode(F.slice("prefix", F.col("rare") + 1, F.lit(FIRST))).alias("at", "token"),
        *("doc", "spot", "id", "n", "rare", *BITS),
    ).withColumn("pos", F.col("rare") + F.col("at") + 1)
    leaders = rarest.groupBy("token").agg(F.min(F.struct(*entry)).alias("y"), F.count("*").alias("members"))
    leaders = leaders.where("members > 1").select("token", *[f"y.{k}" for k in ("id", "n", "pos", *BITS)])
    narrow = rarest.select("token", "id", "n", "pos", *BITS)
    return (
        narrow.alias("x")
        .join(leaders.alias("y"), "token")
        .where((F.col("x.id") != F.col("y.id")) & _may_match(percent))
        .select(F.least("x.id", "y.id").alias("id"), F.greatest("x.id", "y.id").alias("other"))
        .distinct()
    )


def _other_pairs(seen: DataFrame, settled: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes that share a token of the prefix and may match, whose later one is not settled."""
    known = settled.withColumn("settled", F.lit(True))
    if settled.count() <= BROADCAST_LINES:
        known = F.broadcast(known)
    classes = seen.join(known, "id", "left").withColumn("settled", F.coalesce("settled", F.lit(False)))
    # both sides' columns in every condition, so that neither is filtered or cut on its own and both read one shuffle
    none = F.when(F.col("x.settled"), F.lit(-1)).otherwise(F.lit(-2))
    open_later = F.col("x.id") < F.when(F.col("y.settled"), none).otherwise(F.col("y.id"))
    earlier = (F.col("x.id") < F.col("y.id")) & open_later

    def met(k: int) -> DataFrame:
        entries = classes.select("id", "n", *BITS, "settled", F.posexplode("prefix").alias("at", "token"))
        entries = entries.where(F.pmod("token", F.lit(KEY_PASSES)) == k)
        entries = entries.select("token", "id", "n", (F.col("at") + 1).alias("pos"), "settled", *BITS)
        may = (F.col("x.token") == F.col("y.token")) & earlier & _may_match(percent)
        joined = entries.alias("x").join(entries.alias("y"), may)
        return joined.select(F.col("x.id").alias("id"), F.col("y.id").alias("other")).distinct()

    # written here, so that the files of a large shuffle of entries go before the next ones come
    return reduce(DataFrame.union, [written(met(k), "line-candidates") for k in range(KEY_PASSES)]).distinct()


def dedup_lines(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` without the lines that ``line_decisions`` lets go; ``n_chars``, if there, counts what is left.

    Lines without words stay. A document whose every line with words goes is left out; one that had none stays
    as it is, as do null texts. Rows keep their other columns, whatever their names.
    """
    decisions = line_decisions(docs, percent)
    lost = (
        decisions.groupBy("doc_id", "version")
        .agg(F.collect_set(F.when(~F.col("kept"), F.col("line_no"))).alias("gone"), F.bool_or("kept").alias("left"))
        .where(F.size("gone") > 0)
    )
    lost = written(lost, "lost-lines")
    if lost.agg(F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()[0] <= BROADCAST_LINES:
        lost = F.broadcast(lost)  # otherwise the texts are shuffled
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    rows = rows.select("row", "doc_id", _document()[1])
    same = F.expr("r.doc_id <=> g.doc_id and r.version = g.version")
    found = rows.alias("r").join(lost.alias("g"), same, "left").where(F.coalesce("g.left", F.lit(True)))
    lines = F.split(F.col("row.text").cast("string"), "\n")
    staying = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("g.gone"))
    text = F.array_join(F.transform(staying, lambda k: F.get(lines, k)), "\n")
    row = F.when(F.col("g.gone").isNull(), F.col("row")).otherwise(F.col("row").withField("text", text))
    found = found.select(row.alias("row")).select("row.*")
    if "n_chars" in docs.columns:
        found = found.withColumn(
            "n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
        )
    return found
