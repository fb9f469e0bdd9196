"""Conversations repaired by the cheapest edits that make their roles alternate."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Characters that stand between words, and those that end a sentence.
BLANKS, ENDS = " \t\n\v\f\r", ".!?"
#: What an edit costs: keeping a turn, giving it the role that fits, deleting it, inserting one without text.
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
#: What a turn that breaks off adds if it stays.
TRUNCATED = 1
#: Pairs of role initials that may follow each other.
LEGAL = ("su", "ua", "au")
#: Bytes of backpointers that a conversation keeps in memory before they go to a file of the task.
SPILL_BYTES = 4 << 20

# The states of the role grammar `(s?(ua)+)?`: nothing yet, after the setting, after a user, after an assistant.
EMPTY, SETTING, USER, ASSISTANT = range(4)
#: The state that a role's initial leads to; there is at most one role that can come next besides the setting.
STEPS = {
    (EMPTY, "s"): SETTING,
    (EMPTY, "u"): USER,
    (SETTING, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
NEXT_SPEAKER = {EMPTY: "u", SETTING: "u", USER: "a", ASSISTANT: "u"}
SPEAKERS = {"u": "user", "a": "assistant"}
FAULTS = ("", "blank", "duplicate", "truncated")


def _inserts(state: int) -> list[int]:
    """The states after no, one, ... inserted turns, until one comes again."""
    states = [state]
    while (after := STEPS[states[-1], NEXT_SPEAKER[states[-1]]]) not in states:
        states.append(after)
    return states


#: Inserts that lead from a state to one where a conversation may end, or None.
TO_END = {q: next((k for k, r in enumerate(_inserts(q)) if r in (EMPTY, ASSISTANT)), None) for q in range(4)}


@lru_cache(maxsize=1 << 16)
def advance(
    initial: str, must_go: bool, truncated: bool, costs: tuple[int | None, ...], order: tuple[int, ...]
) -> tuple[int, tuple[int | None, ...], tuple[int, ...], tuple[tuple[int, int, str] | None, ...]]:
    """One turn of the search: ``costs`` of the cheapest edits so far that end in each state, and the states in
    the order of those edits' initials; costs are over ``least``, which is returned with the new ones.

    For each state the way into it: the state before, the number of inserts, the edit. Edits that lead to two
    states, or to one by two ways, consist of as many turns and end with one, so none is the beginning of another:
    their order stays whatever is added, and the cheapest and least so far is enough to go on.
    """
    rank = {q: k for k, q in enumerate(order)}
    ways: list[tuple[int, int, str, int, int]] = []  # state, cost, letters, state before, inserts
    for q, cost in enumerate(costs):
        if cost is None:
            continue
        for k, r in enumerate(_inserts(q)):
            paid, letters = cost + k * INSERT, "I" * k
            ways.append((r, paid + DELETE, letters + "D", q, k))
            if must_go:
                continue
            stays = paid + TRUNCATED * truncated
            if (r, initial) in STEPS:
                ways.append((STEPS[r, initial], stays + KEEP, letters + "K", q, k))
            ways.append((STEPS[r, NEXT_SPEAKER[r]], stays + REROLE, letters + "R", q, k))
    best: list[tuple | None] = [None] * 4
    for way in ways:
        key = (way[1], rank[way[3]], way[2])
        if best[way[0]] is None or key < best[way[0]][0]:
            best[way[0]] = (key, way)
    found = [q for q in range(4) if best[q]]
    least = min(best[q][0][0] for q in found)
    return (
        least,
        tuple(best[q][0][0] - least if best[q] else None for q in range(4)),
        tuple(sorted(found, key=lambda q: best[q][0][1:])),
        tuple((best[q][1][3], best[q][1][4], best[q][1][2][-1]) if best[q] else None for q in range(4)),
    )


@lru_cache(maxsize=1 << 12)
def _packed(ways: tuple[tuple[int, int, str] | None, ...]) -> bytes:
    """Backpointers of the four states, one byte each."""
    return bytes(0 if w is None else w[0] | w[1] << 2 | "DKR".index(w[2]) << 4 for w in ways)


class Conversation:
    """The cheapest repairs of the turns seen so far, one for each state.

    A repaired text is held as its running hash and the edits as four bytes a turn, so memory does not grow with
    the texts, and backpointers beyond ``spill_bytes`` lie in an unnamed file that ends with the task.
    """

    def __init__(self, key: str, spill_bytes: int = SPILL_BYTES):
        self.key = key
        self.counts = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal"), 0)
        self.turns: list[int | None] = [None, None, 0]  # the least, the latest, how many
        self.before: str | None = None
        self.n = 0
        self.least, self.costs, self.order = 0, (0, None, None, None), (EMPTY,)
        self.hashes = [hashlib.sha256(), None, None, None]
        self.pointers = tempfile.SpooledTemporaryFile(max_size=spill_bytes)

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None and turn != self.turns[1]:
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn, self.turns[2] + 1]
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.before = initial
        if fault:
            self.counts[fault] += 1
        least, self.costs, self.order, ways = advance(
            initial if initial in ("s", "u", "a") else "",
            fault in ("blank", "duplicate"),
            fault == "truncated",
            self.costs,
            self.order,
        )
        self.least += least
        self.n += 1
        self.pointers.write(_packed(ways))
        said = text.encode("utf-8", "surrogatepass")
        self.hashes = [None if way is None else self._hash(way, role, said) for way in ways]

    def _hash(self, way: tuple[int, int, str], role: str, said: bytes):
        """The hash of the repaired text that a way leads to; those of other ways stay as they are."""
        state, inserts, edit = way
        digest = self.hashes[state]
        if edit == "D" and not inserts:
            return digest
        digest = digest.copy()
        for _ in range(inserts):
            state = _spoken(digest, state, NEXT_SPEAKER[state], None, b"")
        if edit == "K":
            _spoken(digest, state, None, role, said)
        elif edit == "R":
            _spoken(digest, state, NEXT_SPEAKER[state], None, said)
        return digest

    def row(self) -> tuple:
        ends = [q for q in self.order if TO_END[q] is not None]
        end = min(ends, key=lambda q: self.costs[q] + INSERT * TO_END[q])  # the first of equal ones has the least edits
        digest, state = self.hashes[end].copy(), end
        for _ in range(TO_END[end]):
            state = _spoken(digest, state, NEXT_SPEAKER[state], None, b"")
        first, last, distinct = self.turns
        self.counts["gaps"] = 0 if first is None else last - first + 1 - distinct
        cost = self.least + self.costs[end] + INSERT * TO_END[end]
        audit = self._edits(end) + "I" * TO_END[end]
        self.pointers.close()
        return (self.key, *self.counts.values(), cost, audit, digest.hexdigest())

    def _edits(self, state: int, block: int = 1 << 20) -> str:
        """The edits that lead to a state, read from the last backpointer to the first."""
        letters: list[str] = []
        for begin in range((self.n - 1) // block * block, -1, -block):
            self.pointers.seek(4 * begin)
            held = self.pointers.read(4 * min(block, self.n - begin))
            for at in range(len(held) - 4, -1, -4):
                way = held[at + state]
                letters.append("DKR"[way >> 4])
                if way >> 2 & 3:
                    letters.append("I" * (way >> 2 & 3))
                state = way & 3
        return "".join(reversed(letters))


def _spoken(digest, state: int, initial: str | None, role: str | None, said: bytes) -> int:
    """Add one turn to a repaired text; returns the state after it if it is a speaker's."""
    if state != EMPTY:
        digest.update(b"\n")
    name = role if initial is None else SPEAKERS[initial]
    digest.update(name.encode("utf-8", "surrogatepass") + b":")
    digest.update(said)
    return state if initial is None else STEPS[state, initial]


RESULT = (
    "conv_key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def _stream(batches: Iterator[pd.DataFrame], spill_bytes: int, at_once: int = 4096) -> Iterator[pd.DataFrame]:
    """Conversations from sorted turns; one may begin in a batch and end many batches later."""
    names = [field.split()[0] for field in RESULT.split(", ")]
    open_one: Conversation | None = None
    rows: list[tuple] = []
    held = 0
    for batch in batches:
        columns = [batch[c].tolist() for c in ("conv_key", "turn", "no_turn", "role", "text", "fault")]
        for key, turn, no_turn, role, text, fault in zip(*columns, strict=True):
            if open_one is None or open_one.key != key:
                if open_one is not None:
                    rows.append(open_one.row())
                    held += len(rows[-1][7])
                open_one = Conversation(key, spill_bytes)
            if fault != "dropped":
                open_one.add(None if no_turn else turn, role, text, fault)
        if len(rows) >= at_once or held >= spill_bytes:
            yield pd.DataFrame(rows, columns=names)
            rows, held = [], 0
    if open_one is not None:
        rows.append(open_one.row())
    if rows:
        yield pd.DataFrame(rows, columns=names)


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_key, turn, role, text, copy, dropped`` after damage by the checksum of each row's key.

    A null counts as one space, in the key as well. A row that is dropped stays as a mark without a text, so that
    its conversation is known.
    """
    space = F.lit(" ")
    conv = F.coalesce(F.col("conv_id").cast("string"), space)
    key = F.concat(conv, F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = turns.select(
        conv.alias("conv_key"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("how"),
    )
    how = F.col("how")
    text = F.when(how.isin(0, 1), "").when(how == 2, F.regexp_replace("text", f"[{ENDS}]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_key",
        "turn",
        F.when(how == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (how == 0).alias("dropped"),
        F.explode(F.when(how == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def _in_order() -> list[Column]:
    """Turns as they follow each other, nulls first; rows of one turn by what they say."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")]


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``fault``: dropped, blank, duplicate, truncated or empty, dealt out by conversation.

    A row is a duplicate of an earlier row of its conversation with equal role and text. Its window takes rows
    by (conversation, role, text), which needs no other shuffle than that by conversation.
    """
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    same = W.partitionBy("conv_key", "dropped", "role", "text").orderBy(*_in_order())
    return (
        rows.repartition("conv_key")
        .withColumn("earlier", F.row_number().over(same) - 1)
        .withColumn(
            "fault",
            F.when(F.col("dropped"), "dropped")
            .when(end == "", "blank")
            .when(F.col("earlier") > 0, "duplicate")
            .when(~F.right(end, F.lit(1)).isin(*ENDS), "truncated")
            .otherwise(""),
        )
    )


def repair(rows: DataFrame, spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """``conv_key`` and the cheapest repair of each conversation of ``rows``, which hold ``fault``.

    Rows lie by conversation, sorted by turn, and stream through the search in Arrow batches, so a conversation
    may be longer than memory. It needs its whole audit, a letter for each edit, once, as its result does.
    """
    lean = rows.select(
        "conv_key",
        # pandas has no null in whole numbers
        F.coalesce("turn", F.lit(0)).alias("turn"),
        F.col("turn").isNull().alias("no_turn"),
        "role",
        "text",
        "copy",
        "fault",
    )
    order = ["conv_key", F.col("no_turn").desc(), "turn", "role", "text", "copy"]
    return lean.sortWithinPartitions(*order).mapInPandas(lambda batches: _stream(batches, spill_bytes), RESULT)


def repaired(turns: DataFrame, spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of damaged ``turns``.

    One row for every ``conv_id`` of ``turns``, null among them, even where the damage leaves no row: then the
    figures are 0, the audit is empty and the hash that of nothing. Nulls count as one space, so a row with a
    null text is blank and one with a null role fits nowhere, nor does one with an empty role. Rows that tie on
    the turn, and repeated rows, follow each other by role and text in the order of their bytes; a repeated row
    is a duplicate of the first. Very long texts are hashed as they pass. An empty table gives none. Further
    columns are not read. Turns that are no whole numbers are read as such.
    """
    kind = turns.schema["conv_id"].dataType
    found = repair(with_faults(damaged(turns)), spill_bytes)
    conv = F.when(F.col("conv_key") != " ", F.col("conv_key")).cast(kind)
    return found.select(conv.alias("conv_id"), *[name for name in found.columns if name != "conv_key"])
