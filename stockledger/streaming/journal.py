"""The journal kept up to date from files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stockledger.plans import lakehouse
from stockledger.streaming.drift import batch_name


def start_journal(
    spark: SparkSession,
    root: str,
    source: str,
    checkpoint: str,
    schema: StructType,
    lookback_days: int = 0,
    glob: str = "*.parquet",
    files_per_batch: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Add journal lines to the silver journal as their files arrive, as ``lakehouse.append_journal`` does.

    A line is taken if its id is unknown and it is not older than the newest loaded date less ``lookback_days``;
    what is older goes to the area ``late`` of the journal, once for each id. The loaded journal itself is the
    state: ids are looked up in its last ``lookback_days``, so there is no second copy of them that could be lost,
    and a watermark's operator would drop late lines where they are kept here. Loaded, waiting and late lines of a
    batch appear in one step, and a batch that is run again is applied once.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def add(rows: DataFrame, number: int) -> None:
        own = rows.sparkSession
        lakehouse.append_rows(own, root, rows, lookback_days, batch_name(own, number))

    writer = reader.parquet(source).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()
