import hashlib
import itertools
import random
import re
import zlib

import pytest

from stockledger.llm import repair

TURNS = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    """``(conv, turn, role, text)`` after damage, in order, by conversation."""
    found = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        how = zlib.crc32(key.encode()) % 20
        left = found.setdefault(conv, [])
        if how == 1:
            text = ""
        if how == 2:
            text = re.sub("[.!?]", "", text)
        if how == 4:
            role = "user"
        left += [(turn, role, text)] * {0: 0, 3: 2}.get(how, 1)
    for left in found.values():
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return found


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        letters = BLANK.findall(text)
        if not letters:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if letters[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def every_edit(rows):
    """The cheapest repair by trying all edits, with at most two turns inserted in one place."""
    wrong = faults(rows)
    between = ["", "u", "a", "ua", "au"]
    name = {"u": "user", "a": "assistant"}
    best = None
    edits = []
    for (_, role, text), fault in zip(rows, wrong, strict=True):
        ways = [("D", 3, None)]
        if fault not in ("blank", "duplicate"):
            more = fault == "truncated"
            ways += [("K", more, (role, text)), ("R", 2 + more, ("user", text)), ("R", 2 + more, ("assistant", text))]
        edits.append(ways)
    for chosen in itertools.product(*edits):
        for put in itertools.product(between, repeat=len(rows) + 1):
            turns, audit, cost = [], "", 0
            for k in range(len(rows) + 1):
                turns += [(name[c], "") for c in put[k]]
                audit += "I" * len(put[k])
                cost += 2 * len(put[k])
                if k < len(rows):
                    audit += chosen[k][0]
                    cost += chosen[k][1]
                    turns += [chosen[k][2]] if chosen[k][2] else []
            if re.fullmatch("(s?(ua)+)?", "".join(role[:1] or "-" for role, _ in turns)):
                said = "\n".join(f"{role}:{text}" for role, text in turns)
                best = min(best or (cost, audit, said), (cost, audit, said))
    return best


def from_the_end(rows):
    """The same by the cost from each turn and state to the end, then the least letter that stays cheapest."""
    wrong = faults(rows)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    fits = {"": "u", "s": "u", "u": "a", "a": "u"}
    far = 10**9

    def ways(k, state, cost):
        if k < len(rows):
            _, role, text = rows[k]
            yield "D", 3, state, k + 1, None
            if wrong[k] not in ("blank", "duplicate"):
                more = wrong[k] == "truncated"
                if (state, role[:1]) in step:
                    yield "K", more, step[state, role[:1]], k + 1, (role, text)
                yield "R", 2 + more, fits[state], k + 1, ({"u": "user", "a": "assistant"}[fits[state]], text)
        if cost is None or fits[state] in cost[k]:
            yield "I", 2, fits[state], k, ({"u": "user", "a": "assistant"}[fits[state]], "")

    cost = [dict.fromkeys(["", "s", "u", "a"], far) for _ in range(len(rows) + 1)]
    for k in range(len(rows), -1, -1):
        if k == len(rows):
            cost[k][""] = cost[k]["a"] = 0
        for _ in range(4):
            for state in cost[k]:
                for _, paid, after, at, _ in ways(k, state, None):
                    cost[k][state] = min(cost[k][state], paid + cost[at][after])
    k, state, audit, turns = 0, "", "", []
    while k < len(rows) or cost[k][state]:
        letter, _, state, k, turn = min(
            (w for w in ways(k, state, None) if w[1] + cost[w[3]][w[2]] == cost[k][state]), key=lambda w: w[0]
        )
        audit += letter
        turns += [turn] if turn else []
    return cost[0][""], audit, "\n".join(f"{role}:{text}" for role, text in turns)


def wanted(rows, solve):
    found = set()
    for conv, left in damage(rows).items():
        wrong = faults(left)
        turns = [t for t, _, _ in left if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(left)]
        cost, audit, said = solve(left)
        found.add(
            (conv, gaps, *(wrong.count(f) for f in ("blank", "duplicate", "truncated")),
             sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(said.encode()).hexdigest())
        )
    return found


def drawn(seed, conversations, length, texts=("Yes.", "No", " ", "Why? ", "Yes.", "é漢")):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    rows = []
    for conv in range(conversations):
        for turn in range(r.randrange(length + 1)):
            role = r.choice(roles) if r.random() < 0.4 else ["user", "assistant"][turn % 2]
            rows.append((conv, turn if r.random() < 0.9 else None, role, r.choice([*texts, None, f"t{turn}."])))
    return rows


def run(spark, rows, **more):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, TURNS).withColumns({n: F.lit("own") for n in ("fault", "copy", "conv_key", "cost")})
    return repair.repaired(df.repartition(3), **more).collect()


def test_against_all_edits(spark):
    # after damage a conversation may have more turns than before; six are too many to try
    rows = [r for r in drawn(1, 60, 3)]
    short = {conv for conv, left in damage(rows).items() if len(left) <= 3}
    rows = [r for r in rows if r[0] in short]
    found = run(spark, rows)
    assert {tuple(r) for r in found} == wanted(rows, every_edit) and len(found) == len(short)


def test_against_a_search_from_the_end(spark):
    rows = drawn(2, 150, 25) + [(None, 0, "user", "A."), (None, 1, "assistant", "B."), (None, None, None, None)]
    rows += [(500, 3, "user", "Same."), (500, 3, "user", "Same."), (500, 3, "assistant", "Other.")]
    found = run(spark, rows)
    assert {tuple(r) for r in found} == wanted(rows, from_the_end) and len(found) == len({r[0] for r in rows})


def test_a_conversation_goes_on_over_batches_and_spills(spark):
    rows = drawn(3, 1, 0) + [
        (7, k, random.Random(k).choice(["user", "assistant"]), random.Random(k).choice(["Yes.", "No", f"t{k}."]))
        for k in range(6000)
    ]
    rows += [(8, 0, "user", "Ask? " * 200_000 + "."), (8, 1, "assistant", "Say." * 200_000)]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        found = run(spark, rows, spill_bytes=64)
    finally:
        spark.conf.set(key, before)
    assert {tuple(r) for r in found} == wanted(rows, from_the_end)


def test_all_rows_dropped_and_no_rows(spark):
    gone = [k for k in range(400) if zlib.crc32(f"{k}:0".encode()) % 20 == 0]
    assert len(gone) > 5
    found = run(spark, [(k, 0, "user", "A.") for k in gone])
    nothing = hashlib.sha256(b"").hexdigest()
    assert {tuple(r) for r in found} == {(k, 0, 0, 0, 0, 0, 0, "", nothing) for k in gone}
    assert run(spark, []) == []


@pytest.mark.parametrize("kinds", ["conv_id string, turn int, role string, text string"])
def test_ids_keep_their_kind(spark, kinds):
    df = spark.createDataFrame([("x", 1, "user", "A."), ("x", 2, "assistant", "B.")], kinds)
    assert [r.conv_id for r in repair.repaired(df).collect()] == ["x"]


def test_one_shuffle(spark):
    plan = repair.repaired(spark.createDataFrame([], TURNS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
