from pyspark.sql import functions as F

from stockledger.operators import incremental
from tests.rows import by, day, frame

JOURNAL = "journal_id string, posting_date date, amount double"


def test_append_takes_new_and_late_rows_once(spark):
    source = frame(spark, JOURNAL, [
        ("1", day("2025-01-01"), 1.0), ("2", day("2025-01-31"), 1.0),
        ("late", day("2025-01-25"), 1.0), ("too late", day("2025-01-01"), 1.0),
        ("3", day("2025-02-01"), 1.0),
    ])
    target = source.filter("journal_id in ('1', '2')")
    new = incremental.incremental_append(target, source, "journal_id", "posting_date", 10)
    assert {r.journal_id for r in new.collect()} == {"late", "3"}
    same_day = incremental.incremental_append(target, source, "journal_id", "posting_date")
    assert {r.journal_id for r in same_day.collect()} == {"3"}
    everything = incremental.incremental_append(
        target.limit(0), source, "journal_id", "posting_date"
    )
    assert everything.count() == 5
    late = incremental.skipped_rows(target, source, "journal_id", "posting_date", 10)
    assert {r.journal_id for r in late.collect()} == {"too late"}


def test_rows_without_a_date_load_once(spark):
    source = frame(spark, JOURNAL, [("1", day("2025-01-01"), 1.0), ("a", None, 1.0), ("b", None, 1.0)])
    target = source.filter("journal_id <> 'b'")
    for held, expected in ((source.limit(0), {"1", "a", "b"}), (target, {"b"}), (source, set())):
        new = incremental.incremental_append(held, source, "journal_id", "posting_date")
        assert {r.journal_id for r in new.collect()} == expected


def test_append_bound_reaches_the_scan(spark, tmp_path):
    rows = frame(spark, JOURNAL, [("1", day("2025-01-01"), 1.0)])
    rows.write.parquet(f"{tmp_path}/j")
    journal = spark.read.parquet(f"{tmp_path}/j")
    new = incremental.incremental_append(journal, journal, "journal_id", "posting_date")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "(posting_date" in plan and "DataFilters" in plan


def test_date_dim(spark):
    span = frame(spark, "a date, b date", [(day("2024-12-30"), day("2025-03-01"))])
    rows = by(incremental.date_dim(span, "a", "b"), "date")
    assert len(rows) == 62
    assert rows[day("2024-12-30")]["iso_week"] == 1
    leap_end = rows[day("2025-02-28")]
    assert leap_end["is_month_end"] and leap_end["day_of_week"] == 5 and not leap_end["is_weekend"]
    assert rows[day("2025-03-01")]["is_weekend"] and rows[day("2025-03-01")]["date_key"] == 20250301


def test_scd2_closes_opens_and_keeps(spark):
    history = frame(
        spark,
        "id string, terms long, name string, valid_from date, valid_to date, is_current boolean",
        [
            ("same", 30, None, day("2024-01-01"), None, True),
            ("changed", 30, "x", day("2024-01-01"), day("2024-06-01"), False),
            ("changed", 45, "x", day("2024-06-01"), None, True),
            ("gone", 60, "x", day("2024-01-01"), None, True),
            ("to null", 60, "x", day("2024-01-01"), None, True),
        ],
    )
    snapshot = frame(
        spark, "id string, terms long, name string",
        [("same", 30, None), ("changed", 60, "x"), ("new", 30, "x"), ("to null", None, "x")],
    )
    merged = incremental.scd2_merge(history, snapshot, "id", ["terms", "name"], "2025-01-01")
    got = {(r.id, r.terms, str(r.valid_from), str(r.valid_to), r.is_current) for r in merged.collect()}
    assert got == {
        ("same", 30, "2024-01-01", "None", True),
        ("changed", 30, "2024-01-01", "2024-06-01", False),
        ("changed", 45, "2024-06-01", "2025-01-01", False),
        ("changed", 60, "2025-01-01", "None", True),
        ("gone", 60, "2024-01-01", "2025-01-01", False),
        ("to null", 60, "2024-01-01", "2025-01-01", False),
        ("to null", None, "2025-01-01", "None", True),
        ("new", 30, "2025-01-01", "None", True),
    }
    again = incremental.scd2_merge(merged, snapshot, "id", ["terms", "name"], "2025-02-01")
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))


def test_diff_and_apply(spark):
    schema = "id long, v string"
    old = frame(spark, schema, [(1, "a"), (2, "b"), (3, None), (4, None)])
    new = frame(spark, schema, [(1, "a"), (2, "c"), (3, None), (5, "e")])
    changes = incremental.table_diff(old, new, "id")
    assert {(r.id, r.v, r.change) for r in changes.collect()} == {
        (2, "c", "update"), (4, None, "delete"), (5, "e", "insert"),
    }
    applied = incremental.apply_changes(old, changes, "id")
    assert sorted(map(str, applied.collect())) == sorted(map(str, new.collect()))


def test_backfill_leaves_other_months_alone(spark, tmp_path):
    path = f"{tmp_path}/t"
    facts = spark.range(300).select(
        F.add_months(F.lit(day("2025-01-01")), (F.col("id") % 3).cast("int")).alias("month"),
        F.col("id").alias("v"),
    )
    incremental.backfill(facts, path, "month", None)
    incremental.backfill(facts.withColumn("v", F.lit(-1)), path, "month", ["2025-02-01"])
    rows = spark.read.parquet(path).groupBy("month").agg(
        F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    assert {str(r.month): (r.n, r.low, r.high) for r in rows.collect()} == {
        "2025-01-01": (100, 0, 297), "2025-02-01": (100, -1, -1), "2025-03-01": (100, 2, 299),
    }
    gone = facts.filter("month <> date'2025-03-01'")
    incremental.backfill(gone, path, "month", ["2025-03-01"])
    assert spark.read.parquet(path).filter("month = date'2025-03-01'").count() == 0
    assert spark.read.parquet(path).count() == 200
    pruned = spark.read.parquet(path).filter("month = date'2025-02-01'")
    assert "PartitionFilters: [isnotnull(month" in pruned._jdf.queryExecution().toString()
