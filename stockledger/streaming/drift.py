"""Picking up files whose columns change: the table gains columns, and what does not fit is kept in view."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, StructField, StructType

from stockledger.sources import published

#: The area of files that were not loaded.
REJECTED = "rejected"
REJECTED_COLUMNS = "file string, reason string, batch string"
_FILES = "path string, modificationTime timestamp, length long, content binary"
#: Types that a column's values can take without loss, by what a file has.
WIDENS = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
}
#: What Spark says of a file that is no Parquet file and never will be.
NO_PARQUET = (
    "is not a Parquet file",
    "corrupted file",
    "can not read class org.apache.parquet",
    "UNABLE_TO_INFER_SCHEMA",
)
#: Footers that are read at once.
FOOTERS = 16


def _layout(spark: SparkSession, file: str) -> StructType | str:
    """A file's columns, or why it is none. A store that can't be reached fails the batch, which is then repeated."""
    try:
        return spark.read.parquet(file).schema
    except (PySparkException, Py4JJavaError) as problem:
        for sign in NO_PARQUET:
            if sign in str(problem):
                return f"not readable: {sign}"
        raise


def _misfit(layout: StructType, target: dict[str, DataType]) -> str | None:
    """Why a layout can't go into a table, or None."""
    seen: set[str] = set()
    for field in layout.fields:
        name, kind = field.name.lower(), field.dataType.simpleString()
        if name in seen:
            return f"{name}: two columns of this name"
        seen.add(name)
        if name in target:
            wanted = target[name].simpleString()
            if kind != wanted and wanted not in WIDENS.get(kind, ()):
                return f"{name}: {kind} for {wanted}"
    return None


def take_files(spark: SparkSession, path: str, files: Sequence[str], batch: str) -> published.Version | None:
    """Load some Parquet files into the published table at ``path``, once for each ``batch``.

    Columns match by name, whatever their case; the table gains those it lacks, and rows have nulls in those that
    their file lacks. A file that can't be read, that has a column of a type which the table's can't hold without
    loss, or two columns whose names differ by case, is not loaded: it stays where it is, and its name and the
    reason are a row of the area ``rejected``. Loaded rows, the new columns and rejected files appear in one step.
    A file without a single byte leaves no trace. The files of a layout are read together. Of layouts that contradict each other, that of the first file by name
    gives the table's type.
    """
    before = published.latest(spark, path)
    if not files or before and published.applied(spark, path, batch):
        return before
    with ThreadPoolExecutor(FOOTERS) as pool:
        layouts = dict(zip(files, pool.map(lambda file: _layout(spark, file), files), strict=True))
    loaded = before.in_area() if before else []
    target: list[StructField] = []
    if loaded:
        target = published.frame(spark, path, loaded).schema.fields
    groups: dict[str, tuple[StructType, list[str]]] = {}
    rejected: list[tuple[str, str, str]] = []
    for file in sorted(files):
        layout = layouts[file]
        reason = layout if isinstance(layout, str) else _misfit(layout, {f.name: f.dataType for f in target})
        if reason:
            rejected.append((file, reason, batch))
            continue
        known = {field.name for field in target}
        target += [
            StructField(field.name.lower(), field.dataType) for field in layout.fields if field.name.lower() not in known
        ]
        key = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in layout.fields)
        groups.setdefault(key, (layout, []))[1].append(file)
    entries = [entry for entry in (before.entries if before else ())]
    run = published.new_run()
    if groups:
        columns = StructType(target)
        parts = [_as(spark.read.schema(layout).parquet(*some), columns) for layout, some in groups.values()]
        entries = [e for e in entries if e.run or e.area != published.DATA]
        entries += published.stage(reduce(DataFrame.unionByName, parts), path, run)
    if rejected:
        rows = spark.createDataFrame(rejected, REJECTED_COLUMNS).coalesce(1)
        entries += published.stage(rows, path, run, area=REJECTED)
    return published.publish(spark, before, path, entries, batch)


def _as(rows: DataFrame, columns: StructType) -> DataFrame:
    held = {name.lower(): name for name in rows.columns}
    return rows.select(
        *[
            (F.col(f"`{held[f.name]}`") if f.name in held else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in columns.fields
        ]
    )


def start_drift_ingest(
    spark: SparkSession,
    source: str,
    path: str,
    checkpoint: str,
    glob: str = "*.parquet",
    files_per_batch: int = 1000,
    every: str | None = None,
) -> StreamingQuery:
    """Load files that were not seen before, whatever columns they have, as ``take_files`` does.

    The stream carries names of files, at most ``files_per_batch`` at a time, and not their rows. A batch that is
    run again after a failure has its old name, so it is applied once. With ``every`` the query keeps watching.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .select("path")
    )

    def take(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        names = [row["path"] for row in batch.collect()]
        take_files(own, path, names, batch_name(own, number))

    writer = files.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def batch_name(spark: SparkSession, number: int) -> str:
    """A name for a batch of the query that runs in this thread; the same when it is run again."""
    return f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}:{number}"
