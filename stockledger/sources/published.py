"""Tables whose next state is written aside, checked, and then switched to in one step.

A table's rows lie in runs, ``PATH/AREA/run=ID[/COLUMN=DAY]``; a run that is written is never changed. A version,
``PATH/published/version=N``, is one small Parquet file that names the runs that are the table: it appears as a
whole when its job commits, so readers see the state before or the state after. A write that fails leaves runs
that no version names. Only Spark's readers and writers are used, on any store that they reach.

A version may carry the name of the batch that it applied. A batch is looked up before it is applied, and since
its name and all its rows appear in one step, a batch that is sent again changes nothing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StringType, StructType

#: The rows that readers of a table get. Other areas travel with it, such as rows that wait.
DATA = "data"
_ENTRY = "area string, slot string, run string, schema string, batch string, writer string"
#: The name that Spark gives the folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Conflict(RuntimeError):
    """Another writer has published the same version first."""


@dataclass(frozen=True)
class Entry:
    """One folder of rows: a run's, or those of one day in a run."""

    area: str
    slot: str
    run: str
    schema: str

    def folder(self, path: str) -> str:
        return f"{path}/{self.area}/run={self.run}" + (f"/{self.slot}" if self.slot else "")


@dataclass(frozen=True)
class Version:
    """What a table is at one time."""

    path: str
    number: int
    entries: tuple[Entry, ...] = ()

    def in_area(self, area: str = DATA) -> list[Entry]:
        return [e for e in self.entries if e.area == area]


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{_ENTRY}, version int").parquet(f"{path}/published")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def latest(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The newest version of a table, or that of a number; None if the path holds no published table."""
    versions = _versions(spark, path)
    if versions is None:
        return None
    wanted = versions.agg(F.max("version")).scalar() if number is None else F.lit(number)
    rows = versions.where(F.col("version") == wanted).collect()
    if not rows:
        if number is None:
            return None
        raise ValueError(f"{path} has no version {number}")
    first = min(row["writer"] for row in rows)  # of writers that raced for a number
    entries = [Entry(r["area"], r["slot"], r["run"], r["schema"]) for r in rows if r["writer"] == first and r["area"]]
    return Version(path, rows[0]["version"], tuple(sorted(entries, key=lambda e: (e.area, e.slot, e.run))))


def applied(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether some version of the table has applied a batch."""
    versions = _versions(spark, path)
    return versions is not None and bool(versions.where(F.col("batch") == batch).limit(1).count())


def frame(spark: SparkSession, path: str, entries: Sequence[Entry], schema: StructType | None = None) -> DataFrame:
    """The rows of some entries of one area, with the columns of the newest of them."""
    if not entries and schema is None:
        raise ValueError(f"{path} has no rows and no columns here")
    schema = schema or StructType.fromJson(json.loads(max(entries, key=lambda e: e.run).schema))
    folders = [e.folder(path) for e in entries if e.run]
    if not folders:
        return spark.createDataFrame([], schema)
    # the run is a part of the path, and a column unless it is dropped
    table = (
        spark.read.schema(StructType([*schema.fields, StructField("run", StringType())]))
        .option("basePath", f"{path}/{entries[0].area}")
        .parquet(*folders)
    )
    return table.select(*schema.names)


def read(spark: SparkSession, path: str, area: str = DATA, number: int | None = None) -> DataFrame | None:
    """A table as of its newest version, or of an earlier one; None if it is not published or lacks the area."""
    version = latest(spark, path, number)
    entries = version.in_area(area) if version else []
    return frame(spark, path, entries) if entries else None


def new_run() -> str:
    """A name for a run; later names sort behind."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, path: str, run: str, column: str | None = None, area: str = DATA) -> list[Entry]:
    """Write rows aside and return the entries that would make them part of the table.

    With a date ``column`` the rows lie in a folder for each day. Rebalancing gathers a day's rows in few files and
    lets adaptive execution split a day that is larger than the rest.
    """
    whole = Entry(area, "", run, df.schema.json())
    folder = whole.folder(path)
    if column is None:
        df.write.parquet(folder)
        return [whole]
    if not isinstance(df.schema[column].dataType, DateType):
        raise ValueError(f"{column} is no date")
    df.write.partitionBy(column).parquet(folder)
    written = df.sparkSession.read.schema(df.schema).parquet(folder)
    days = [row[0] for row in written.select(F.col(column).cast("string")).distinct().collect()]
    slots = sorted(f"{column}={NO_VALUE if day is None else day}" for day in days)
    return [replace(whole, slot=slot) for slot in slots]


def publish(
    spark: SparkSession, before: Version | None, path: str, entries: Iterable[Entry], batch: str | None = None
) -> Version:
    """Make ``entries`` the table. ``before`` is the version they were worked out from.

    If another writer publishes on the same version, one of both fails: the table is that of the other.
    """
    number = before.number + 1 if before else 1
    writer = new_run()
    rows = [(e.area, e.slot, e.run, e.schema, None, writer) for e in entries]
    rows.append((None, None, None, None, batch, writer))
    folder = f"{path}/published/version={number:08d}"
    newest = latest(spark, path)
    if (newest.number if newest else 0) >= number:
        raise Conflict(f"{path} is at version {newest.number}")
    spark.createDataFrame(rows, _ENTRY).coalesce(1).write.mode("append").parquet(folder)
    version = latest(spark, path, number)
    if spark.read.parquet(folder).agg(F.min("writer")).first()[0] != writer:
        raise Conflict(f"{path} has another version {number}")
    return version


#: What looks at staged rows before they are published, and raises if they must not be.
Check = Callable[[DataFrame], None]


def replace_table(
    df: DataFrame, path: str, column: str | None = None, check: Check | None = None, batch: str | None = None
) -> Version:
    """Make ``df`` the table's rows; other areas stay."""
    spark, before = df.sparkSession, latest(df.sparkSession, path)
    entries = stage(df, path, new_run(), column)
    return _checked(spark, before, path, entries, df.schema, [], check, batch)


def replace_days(
    df: DataFrame,
    path: str,
    column: str,
    days: Sequence[str],
    check: Check | None = None,
    batch: str | None = None,
) -> Version:
    """Replace some days of the table by those rows of ``df`` that bear them; a day without rows is empty then."""
    spark, before = df.sparkSession, latest(df.sparkSession, path)
    df = df.filter(F.col(column).isin([F.lit(day).cast("date") for day in days]))
    entries = stage(df, path, new_run(), column)
    wanted = {row[0] for row in spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").cast("string")).collect()}
    gone = {f"{column}={day}" for day in wanted}
    kept = [e for e in (before.in_area() if before else []) if e.slot not in gone and e.slot]
    return _checked(spark, before, path, entries, df.schema, kept, check, batch)


def append(df: DataFrame, path: str, check: Check | None = None, batch: str | None = None) -> Version:
    """Add rows to a table that has no days; a batch that was applied before is not applied again."""
    spark, before = df.sparkSession, latest(df.sparkSession, path)
    if before and batch is not None and applied(spark, path, batch):
        return before
    entries = stage(df, path, new_run())
    return _checked(spark, before, path, entries, df.schema, before.in_area() if before else [], check, batch)


def _checked(
    spark: SparkSession,
    before: Version | None,
    path: str,
    fresh: list[Entry],
    schema: StructType,
    kept: list[Entry],
    check: Check | None,
    batch: str | None,
) -> Version:
    if check is not None:
        check(frame(spark, path, fresh, schema))
    # a table without rows still has columns
    empty = [] if fresh or kept else [Entry(DATA, "", "", schema.json())]
    kept = [e for e in kept if e.run]
    others = [e for e in before.entries if e.area != DATA] if before else []
    return publish(spark, before, path, [*kept, *fresh, *empty, *others], batch)


def compact(spark: SparkSession, path: str, area: str = DATA) -> Version | None:
    """Gather the runs of a table without days in one; for tables that grow by many small batches."""
    before = latest(spark, path)
    runs = [e for e in (before.in_area(area) if before else []) if e.run]
    if len(runs) < 2 or any(e.slot for e in runs):
        return before
    entries = stage(frame(spark, path, runs), path, new_run(), area=area)
    return publish(spark, before, path, [*(e for e in before.entries if e.area != area), *entries])


def unused_runs(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Folders of runs that none of the last ``keep`` versions names, and that began before the oldest of them.

    They are what ``remove_unused`` deletes. A run that is being written is newer than any published one.
    """
    versions = _versions(spark, path)
    newest = latest(spark, path)
    if versions is None or newest is None:
        return []
    named = versions.where((F.col("version") > newest.number - keep) & (F.col("run") != "")).select("area", "run")
    held = {(row["area"], row["run"]) for row in named.distinct().collect()}
    first = min((run for _, run in held), default="")
    areas = [row[0] for row in versions.where(F.col("area").isNotNull()).select("area").distinct().collect()]
    found = []
    for area in areas:
        folders = _folders(spark, f"{path}/{area}")
        runs = [folder.rsplit("run=", 1)[1] for folder in folders if "run=" in folder]
        found += [f"{path}/{area}/run={run}" for run in runs if (area, run) not in held and run < first]
    return sorted(found)


def remove_unused(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete what ``unused_runs`` names; earlier versions than the last ``keep`` can't be read any more."""
    gone = unused_runs(spark, path, keep)
    for folder in gone:
        target, files = _file_system(spark, folder)
        files.delete(target, True)
    return gone


def _file_system(spark: SparkSession, folder: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, folder: str) -> list[str]:
    target, files = _file_system(spark, folder)
    if not files.exists(target):
        return []
    return [status.getPath().getName() for status in files.listStatus(target) if status.isDirectory()]
