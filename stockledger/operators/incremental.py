"""Incremental loads, history and change sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def incremental_append(
    target: DataFrame, source: DataFrame, key: str, cursor: str, lookback_days: int = 0
) -> DataFrame:
    """Source rows that the target does not hold yet.

    Rows dated before the target's newest date, less a lookback for late
    postings, are skipped (``skipped_rows`` tells which); the bound is one
    scalar subquery, so both scans push it down to their files. Inside the
    overlap, and among rows without a date, rows are told apart by key. An
    empty target takes everything.
    """
    recent = F.col(cursor).isNull() | (F.col(cursor) >= _bound(target, cursor, lookback_days))
    held = target.filter(recent).select(key)
    return source.filter(recent).join(held, key, "left_anti")


def skipped_rows(
    target: DataFrame, source: DataFrame, key: str, cursor: str, lookback_days: int = 0
) -> DataFrame:
    """Source rows behind the bound of ``incremental_append`` that the target lacks: late postings."""
    late = F.col(cursor) < _bound(target, cursor, lookback_days)
    held = target.filter(late).select(key)
    return source.filter(late).join(held, key, "left_anti")


def _bound(target: DataFrame, cursor: str, lookback_days: int) -> Column:
    newest = F.date_sub(F.max(cursor), lookback_days)
    return target.agg(F.coalesce(newest, F.lit("0001-01-01").cast("date"))).scalar()


def date_dim(days: DataFrame, start: str, end: str) -> DataFrame:
    """Calendar attributes of every day between two date columns of each row.

    Usually ``days`` is the one row of first and last date of a fact table.
    """
    day = F.col("date")
    return days.select(
        F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))).alias("date")
    ).select(
        "date",
        F.date_format(day, "yyyyMMdd").cast("long").alias("date_key"),
        F.year(day).cast("long").alias("year"),
        F.quarter(day).cast("long").alias("quarter"),
        F.month(day).cast("long").alias("month"),
        F.dayofmonth(day).cast("long").alias("day_of_month"),
        F.dayofyear(day).cast("long").alias("day_of_year"),
        # Monday is 1
        (F.weekday(day) + 1).cast("long").alias("day_of_week"),
        F.weekofyear(day).cast("long").alias("iso_week"),
        F.trunc(day, "month").alias("month_start"),
        F.last_day(day).alias("month_end"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        (day == F.last_day(day)).alias("is_month_end"),
    )


def _changed(tracked: Sequence[str], left: str, right: str) -> Column:
    """Whether any tracked column differs, nulls counting as values."""
    same = F.lit(True)
    for name in tracked:
        same = same & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return ~same


def scd2_merge(
    history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], as_of: Column | str
) -> DataFrame:
    """Next state of a type-2 history after a full snapshot.

    ``history`` holds key, tracked columns, valid_from, valid_to and
    is_current. A changed key gets its current row closed on ``as_of`` and a
    new row opened; a key missing from the snapshot is closed; a new one opened.
    Only current rows take part in the join, at most one per key.
    """
    as_of = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    columns = [key, *tracked, "valid_from", "valid_to", "is_current"]
    past = history.filter(~F.col("is_current")).select(*columns)
    current = history.filter(F.col("is_current")).alias("old")
    fresh = snapshot.select(key, *tracked).alias("new")
    old_key, new_key = F.col(f"old.{key}"), F.col(f"new.{key}")
    paired = current.join(fresh, old_key == new_key, "full")
    held, seen = old_key.isNotNull(), new_key.isNotNull()
    differs = _changed(tracked, "old", "new")
    closes = held & (~seen | differs)

    def version(side: str, valid_from: Column, valid_to: Column, is_current: Column) -> Column:
        return F.struct(
            F.col(f"{side}.{key}").alias(key),
            *[F.col(f"{side}.{name}").alias(name) for name in tracked],
            valid_from.alias("valid_from"),
            valid_to.alias("valid_to"),
            is_current.alias("is_current"),
        )

    never = F.lit(None).cast("date")
    kept = version(
        "old", F.col("old.valid_from"), F.when(closes, as_of).otherwise(never), ~closes
    )
    opened = version("new", as_of, never, F.lit(True))
    versions = F.filter(
        F.array(F.when(held, kept), F.when(seen & (~held | differs), opened)),
        lambda entry: entry.isNotNull(),
    )
    return past.unionByName(paired.select(F.inline(versions)).select(*columns))


def table_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows inserted, updated or deleted between two states of a table.

    Updates and inserts carry the new values, deletes the old ones.
    """
    values = [name for name in old.columns if name != key]
    old_key, new_key = F.col(f"old.{key}"), F.col(f"new.{key}")
    paired = old.alias("old").join(new.alias("new"), old_key == new_key, "full")
    change = (
        F.when(old_key.isNull(), "insert")
        .when(new_key.isNull(), "delete")
        .when(_changed(values, "old", "new"), "update")
    )
    gone = new_key.isNull()
    return paired.withColumn("change", change).filter(F.col("change").isNotNull()).select(
        F.coalesce(new_key, old_key).alias(key),
        *[
            F.when(gone, F.col(f"old.{name}")).otherwise(F.col(f"new.{name}")).alias(name)
            for name in values
        ],
        "change",
    )


def checksum_diff(old: DataFrame, new: DataFrame, key: str, buckets: int = 1 << 12) -> DataFrame:
    """``table_diff`` that moves only the buckets of keys in which the states differ.

    Both states are read once for a count and 128 bits of sums of row hashes per bucket, which is a row for each
    bucket and task; the rows of buckets that agree are left out of the join. The list of those that differ has at
    most ``buckets`` rows and is broadcast. Worth it where few keys change; a change in every bucket costs a second
    reading.
    """
    names = old.columns

    def placed(df: DataFrame) -> DataFrame:
        return df.select(*names).withColumn("_bucket", F.pmod(F.xxhash64(key), buckets).cast("int"))

    def sums(df: DataFrame, side: str) -> DataFrame:
        # a hash passes nulls over, so which columns are null is hashed as well
        nulls = [F.col(name).isNull() for name in names]
        hashes = [F.xxhash64(*names, *nulls), F.xxhash64(F.lit("second"), *nulls, *reversed(names))]
        low, high = F.lit((1 << 32) - 1), 32
        parts = [part for h in hashes for part in (h.bitwiseAND(low), F.shiftrightunsigned(h, high))]
        return df.groupBy("_bucket").agg(
            F.struct(F.count("*"), *[F.sum(part) for part in parts]).alias(side)
        )

    before, after = placed(old), placed(new)
    differing = (
        sums(before, "_old")
        .join(sums(after, "_new"), "_bucket", "full")
        .filter(~F.col("_old").eqNullSafe(F.col("_new")))
        .select("_bucket")
    )
    some = F.broadcast(differing)
    return table_diff(
        before.join(some, "_bucket", "left_semi").drop("_bucket"),
        after.join(some, "_bucket", "left_semi").drop("_bucket"),
        key,
    )


def apply_changes(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Target after the rows of ``table_diff`` are merged into it."""
    upserts = changes.filter(F.col("change") != "delete").select(*target.columns)
    kept = target.join(changes.select(key), key, "left_anti").select(*target.columns)
    return kept.unionByName(upserts)


def backfill(df: DataFrame, path: str, month_column: str, months: Sequence[str] | None) -> None:
    """Write a month-partitioned folder, or replace chosen months of it.

    Only the partitions of the chosen months are overwritten. Spark writes the new rows aside and moves them in when
    the whole write has succeeded; only then months that have no rows any more are emptied, so a write that fails
    leaves every month as it was. Readers may see some months moved and others not: ``published.replace_days``
    changes all at once. The rebalance hint gathers a month's rows into few files and lets adaptive execution split
    a month that is larger than the rest.
    """
    seen = Observation()
    if months is not None:
        chosen = [F.lit(month).cast("date") for month in months]
        df = df.filter(F.col(month_column).isin(chosen))
        rows = [F.count(F.when(F.col(month_column) == day, 1)).alias(f"rows_{k}") for k, day in enumerate(chosen)]
    moved = df.hint("rebalance", F.col(month_column))
    (
        (moved.observe(seen, *rows) if months else moved)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if months is not None else "static")
        .partitionBy(month_column)
        .parquet(path)
    )
    nothing = df.sparkSession.createDataFrame([], df.drop(month_column).schema)
    for k, month in enumerate(months or []):
        if not seen.get[f"rows_{k}"]:
            nothing.write.mode("overwrite").parquet(f"{path}/{month_column}={month}")
