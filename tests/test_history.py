"""Histories from snapshots in any order, facts as of a version."""

import itertools
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stockledger.operators import history, incremental
from tests.rows import day, frame

HISTORY = "id string, terms long, name string, valid_from date, valid_to date, is_current boolean"
SNAPSHOT = "id string, terms long, name string"
TRACKED = ["terms", "name"]
DAYS = ["2024-01-01", "2024-03-01", "2024-06-01", "2024-09-01"]


def states(seed, keys=12):
    """What each key is on each day: (terms, name), or nothing."""
    r = random.Random(seed)
    return {
        d: {f"k{k}": (r.choice([30, 45, None]), r.choice(["x", None])) for k in range(keys) if r.random() < 0.7}
        for d in DAYS
    }


def told(by_day):
    """The versions of states that are known on some days."""
    days, found = sorted(by_day), []
    for key in sorted({key for state in by_day.values() for key in state}):
        open_one = None
        for k, d in enumerate([*days, None]):
            value = by_day[d].get(key) if d else None
            if open_one and (d is None or value != open_one[1]):
                found.append((key, *open_one[1], open_one[0], d, d is None))
                open_one = None
            if d and value and not open_one:
                open_one = (d, value)
    return sorted(found, key=str)


def versions(df):
    return sorted(
        ((r.id, r.terms, r.name, str(r.valid_from), r.valid_to and str(r.valid_to), r.is_current) for r in df.collect()),
        key=str,
    )


def snapshot(spark, state):
    return frame(spark, SNAPSHOT, [(key, *value) for key, value in state.items()] + [(None, 1, "no key")])


def applied(spark, days):
    return frame(spark, "as_of date", [(day(d),) for d in days])


@pytest.mark.parametrize("order", [*itertools.permutations(range(4))][::5])
def test_any_order_of_snapshots_gives_one_history(spark, order):
    by_day = states(1)
    held, seen = frame(spark, HISTORY, []), []
    for k in order:
        d = DAYS[k]
        held = history.apply_snapshot(held, snapshot(spark, by_day[d]), "id", TRACKED, d, applied(spark, seen))
        held = frame(spark, HISTORY, held.collect())
        seen.append(d)
        assert versions(held) == told({d: by_day[d] for d in seen})


def test_a_day_that_arrives_again_replaces_itself(spark):
    by_day = states(2)
    held, seen = frame(spark, HISTORY, []), []
    for d in DAYS:
        held = history.apply_snapshot(held, snapshot(spark, by_day[d]), "id", TRACKED, d, applied(spark, seen))
        held = frame(spark, HISTORY, held.collect())
        seen.append(d)
    by_day[DAYS[1]] = states(3)[DAYS[1]]
    again = history.apply_snapshot(held, snapshot(spark, by_day[DAYS[1]]), "id", TRACKED, DAYS[1], applied(spark, seen))
    assert versions(again) == told(by_day)


def test_a_whole_history_at_once(spark):
    by_day = states(4)
    rows = [(key, *value, day(d)) for d, state in by_day.items() for key, value in state.items()]
    snapshots = frame(spark, f"{SNAPSHOT}, as_of date", [*rows, (None, 1, "x", day(DAYS[0]))])
    assert versions(history.history_of(snapshots, "id", TRACKED)) == told(by_day)


def test_the_newest_snapshot_merges_as_before(spark):
    by_day = states(5)
    old = frame(spark, HISTORY, [(k, t, n, day(f), t2 and day(t2), c) for k, t, n, f, t2, c in told({d: by_day[d] for d in DAYS[:3]})])
    new = snapshot(spark, by_day[DAYS[3]]).where("id is not null")
    late = history.apply_snapshot(old, new, "id", TRACKED, DAYS[3], applied(spark, DAYS[:3]))
    assert versions(late) == versions(incremental.scd2_merge(old, new, "id", TRACKED, DAYS[3]))


FACT = "number long, id string, day date, terms string"


def facts_and_wanted(seed, n, held):
    """Facts of which a half have one key, and what each must get."""
    r = random.Random(seed)
    rows, wanted = [], []
    for number in range(n):
        key = r.choice(["k0"] * 6 + [f"k{k}" for k in range(14)] + [None])
        on = date(2023, 11, 1) + timedelta(days=r.randrange(420)) if r.random() < 0.95 else None
        if r.random() < 0.2:
            on = day(r.choice(DAYS))
        rows.append((number, key, on, "own"))
        match = [
            v for v in held
            if v[0] == key and on and day(v[3]) <= on and (v[4] is None or on < day(v[4]))
        ]
        assert len(match) < 2
        wanted.append((number, key, on, "own", *(match[0][1:3] if match else (None, None))))
    return rows + rows[:20], sorted(wanted + wanted[:20], key=str)


@pytest.mark.parametrize("heavy", [1_000_000, 7])
def test_facts_as_of_their_day(spark, heavy):
    held = told(states(6))
    kept = frame(spark, HISTORY, [(k, t, n, day(f), t2 and day(t2), c) for k, t, n, f, t2, c in held])
    # a version without a day, and one without a key
    kept = kept.unionByName(frame(spark, HISTORY, [("k0", 1, "never", day(DAYS[0]), day(DAYS[0]), False), (None, 1, "x", day(DAYS[0]), None, True)]))
    rows, wanted = facts_and_wanted(7, 500, held)
    facts = frame(spark, FACT, rows).repartition(3)
    found = history.as_of(facts, kept, "id", "day", TRACKED, "was_", heavy)
    assert found.columns == ["number", "id", "day", "terms", "was_terms", "was_name"]
    assert sorted(map(tuple, found.collect()), key=str) == wanted


def test_no_facts_and_no_history(spark):
    nothing = frame(spark, HISTORY, [])
    facts = frame(spark, FACT, [(1, "k0", day("2024-01-01"), "own")])
    assert history.as_of(facts.limit(0), nothing, "id", "day", TRACKED, "was_").collect() == []
    assert tuple(history.as_of(facts, nothing, "id", "day", TRACKED, "was_").first()) == (1, "k0", day("2024-01-01"), "own", None, None)


def test_a_hot_key_is_dealt_out_without_a_join_on_a_range(spark):
    kept = frame(spark, HISTORY, [("hot", 30, "x", day("2020-01-01"), None, True)])
    facts = spark.range(40_000).select(
        F.col("id").alias("number"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.date_add(F.lit(day("2024-01-01")), (F.col("id") % 90).cast("int")).alias("day"),
    )
    found = history.as_of(facts, kept, "id", "day", TRACKED, "was_", heavy=500)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    sizes = [r.n for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 16_000
    assert found.where("was_terms = 30").count() == found.where("id = 'hot'").count() == 26_666
