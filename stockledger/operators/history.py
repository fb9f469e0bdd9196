"""Type-2 histories: from snapshots in any order, and facts as of the version of their day.

A history holds a key, tracked columns, ``valid_from``, ``valid_to`` (null while it lasts) and ``is_current``. The
versions of a key do not overlap; a version holds from its first day up to the day before its last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Stands for an open end while versions are compared.
FAR = "9999-12-31"


def _day(value: Column | str) -> Column:
    return (F.lit(value) if isinstance(value, str) else value).cast("date")


def _versions(pieces: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Versions from pieces with ``start`` and ``end``: pieces that follow on each other with equal values are one."""
    order = W.partitionBy(key).orderBy("start")
    values = F.struct(*tracked)
    goes_on = (F.lag("end").over(order) == F.col("start")) & F.lag(values).over(order).eqNullSafe(values)
    number = F.sum(F.when(goes_on, 0).otherwise(1)).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    far = _day(FAR)
    return (
        pieces.withColumn("number", number)
        .groupBy(key, "number")
        .agg(
            F.first(values).alias("values"),
            F.min("start").alias("valid_from"),
            F.nullif(F.max("end"), far).alias("valid_to"),
        )
        .select(
            key,
            *[F.col("values")[name].alias(name) for name in tracked],
            "valid_from",
            "valid_to",
            F.col("valid_to").isNull().alias("is_current"),
        )
    )


def history_of(snapshots: DataFrame, key: str, tracked: Sequence[str], as_of: str = "as_of") -> DataFrame:
    """The history that full snapshots tell, ``as_of`` being the day of each row's snapshot.

    A key that a snapshot lacks has no version from that day to the next snapshot. Keys are unique within a
    snapshot; rows without a key are left out.
    """
    days = snapshots.select(_day(F.col(as_of)).alias("start")).where("start is not null").distinct()
    # a row for each snapshot
    ends = F.coalesce(F.lead("start").over(W.orderBy("start")), _day(FAR))
    spans = days.withColumn("end", ends)
    pieces = snapshots.where(F.col(key).isNotNull()).select(
        key, *tracked, _day(F.col(as_of)).alias("start")
    )
    return _versions(pieces.join(spans, "start"), key, tracked)


def apply_snapshot(
    history: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: Column | str,
    applied: DataFrame,
) -> DataFrame:
    """The history after one more full snapshot, which may be older than some that it holds already.

    ``applied`` has a column ``as_of`` with the days of the snapshots in the history. The new one tells what held
    from its day up to the next of those: versions are cut there, what they said in between gives way, and pieces
    that agree grow together again. So snapshots give the same history in whatever order they arrive, and a day
    that arrives again replaces what it said before. Only versions that touch that span are grouped, at most four
    a key. Keys are unique within a snapshot; rows without a key are left out.
    """
    start, far = _day(as_of), _day(FAR)
    following = applied.select(_day(F.col("as_of")).alias("day")).where(F.col("day") > start)
    end = following.agg(F.coalesce(F.min("day"), far)).scalar()
    columns = [key, *tracked, "valid_from", "valid_to", "is_current"]
    until = F.coalesce(F.col("valid_to"), far)
    touches = (F.col("valid_from") <= end) & (until >= start)
    kept = F.filter(
        F.array(
            F.struct(F.col("valid_from").alias("start"), F.least(until, start).alias("end")),
            F.struct(F.greatest("valid_from", "next").alias("start"), until.alias("end")),
        ),
        lambda piece: piece["start"] < piece["end"],
    )
    near = history.where(touches).select(*columns, end.alias("next"))
    around = near.select(key, *tracked, F.inline(kept))
    between = snapshot.where(F.col(key).isNotNull()).select(
        key, *tracked, start.alias("start"), end.alias("end")
    )
    return history.where(~touches).select(columns).unionByName(
        _versions(around.unionByName(between), key, tracked).select(columns)
    )


def as_of(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    date: str,
    tracked: Sequence[str],
    prefix: str = "",
    heavy: int = 1_000_000,
) -> DataFrame:
    """Facts with the tracked columns of their key's version on their day, under ``prefix``.

    Facts and versions are sorted together, by key and month, and each fact takes the last version before it; there
    is no join on a range. A version stands once in each month of its span in which its key has facts, so that each
    month is complete by itself. A month of a key with more than ``heavy`` facts is dealt out in pieces with the
    versions in each; that list, which is broadcast, has at most one row for each ``heavy`` facts. Facts without a
    version, a key or a date keep nulls. No fact is lost or doubled.
    """
    rows = facts.select(
        F.col(key).alias("key"),
        F.col(date).cast("date").alias("day"),
        F.trunc(F.col(date).cast("date"), "month").alias("month"),
        F.struct(*[F.col(name) for name in facts.columns]).alias("fact"),
    )
    cells = rows.groupBy("key", "month").agg(F.ceil(F.count("*") / heavy).cast("int").alias("pieces"))
    dealt = F.broadcast(cells.where(F.col("pieces") > 1).select(F.col("key").alias("of"), F.col("month").alias("in"), "pieces"))
    pieces = F.coalesce("pieces", F.lit(1))
    placed = rows.join(dealt, (F.col("key") == F.col("of")) & (F.col("month") == F.col("in")), "left").select(
        "key",
        "month",
        F.pmod(F.xxhash64("fact"), pieces).cast("int").alias("piece"),
        "day",
        F.lit(1).alias("side"),
        "fact",
    )
    span = rows.agg(F.struct(F.min("month").alias("first"), F.max("month").alias("last"))).scalar()
    until = F.coalesce(F.col("valid_to"), _day(FAR))
    held = history.where(F.col("valid_from") < until).select(
        F.col(key).alias("key"),
        F.col("valid_from").alias("from"),
        F.struct(until.alias("until"), *[F.col(name).alias(f"t{k}") for k, name in enumerate(tracked)]).alias("version"),
        F.greatest(F.trunc("valid_from", "month"), span["first"]).alias("first"),
        F.least(F.trunc(F.date_sub(until, 1), "month"), span["last"]).alias("last"),
    )
    months = F.sequence("first", "last", F.expr("interval 1 month"))
    seeds = (
        held.where(F.col("first") <= F.col("last"))
        .withColumn("month", F.explode(months))
        .join(cells, ["key", "month"])
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .select(
            "key", "month", "piece", F.greatest("from", "month").alias("day"), F.lit(0).alias("side"), "version"
        )
    )
    order = W.partitionBy("key", "month", "piece").orderBy("day", "side")
    latest = F.last("version", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    found = (
        placed.unionByName(seeds, allowMissingColumns=True)
        .withColumn("version", latest)
        .where(F.col("side") == 1)
        .withColumn("holds", F.col("day") < F.col("version")["until"])
    )
    return found.select(
        "fact.*",
        *[F.when(F.col("holds"), F.col("version")[f"t{k}"]).alias(f"{prefix}{name}") for k, name in enumerate(tracked)],
    )
