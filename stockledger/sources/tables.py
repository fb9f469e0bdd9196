"""Tables of the lake: one folder of Parquet files each, in three layers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stockledger.sources import published

LAYERS = ("bronze", "silver", "gold")


# one rule places every table
LAYOUT = "{root}/{layer}/{name}"


def table_path(root: str, layer: str, name: str, layout: str = LAYOUT) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return layout.format(root=root.rstrip("/"), layer=layer, name=name)


def read_table(
    spark: SparkSession,
    root: str,
    name: str,
    layer: str = "bronze",
    limit: int | None = None,
    schema: StructType | str | None = None,
    layout: str = LAYOUT,
) -> DataFrame:
    """Scan a table; ``limit`` caps the rows returned.

    Give ``schema`` to skip reading a footer for it. Of a silver or gold table that is published in versions, the
    newest is read; raw tables are plain folders.
    """
    path = table_path(root, layer, name, layout)
    table = published.read(spark, path) if layer != "bronze" and layout == LAYOUT else None
    if table is None:
        reader = spark.read if schema is None else spark.read.schema(schema)
        table = reader.parquet(path)
    return table if limit is None else table.limit(limit)


def write_table(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    partition_by: Sequence[str] | None = None,
) -> str:
    """Replace a table of the lake and return its path."""
    path = table_path(root, layer, name)
    df.write.mode("overwrite").parquet(path, partitionBy=list(partition_by or []) or None)
    return path


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Save ``df`` as a table of the catalog whose rows lie in ``buckets`` by ``keys``, sorted; returns the table.

    Joins and groupings on the keys of tables with equally many buckets need no exchange, however often they run.
    ``table`` may name a schema, which is made if it is not there. A path keeps the files outside the warehouse.
    """
    spark = df.sparkSession
    schema, _, name = table.rpartition(".")
    if schema:
        spark.sql(f"create schema if not exists `{schema}`")
    # each bucket is written by one task, so it is one file
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)
    return spark.table(table)


def export_table(
    df: DataFrame, root: str, name: str, formats: Sequence[str] = ("parquet", "csv")
) -> dict[str, str]:
    """Write extracts of a table, one folder per format; CSV carries a header."""
    paths = {}
    for fmt in formats:
        paths[fmt] = f"{root.rstrip('/')}/{fmt}/{name}"
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer.csv(paths[fmt], header=True)
        else:
            writer.format(fmt).save(paths[fmt])
    return paths


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read a CSV extract with a known schema; nothing is inferred."""
    return spark.read.csv(path, header=True, schema=schema)


def land_bronze(
    spark: SparkSession, sources: Mapping[str, str], root: str, tables: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Land raw Parquet tables, or only the named ones, in the bronze layer.

    ``sources`` maps table names to where their files lie. A missing source
    fails before anything is written. Landing a table again replaces it. Files
    of one source may differ in their columns: the table has all of them.
    """
    names = list(sources) if tables is None else list(tables)
    staged = {name: read_files(spark, sources[name]) for name in names}
    for name, df in staged.items():
        write_table(df, root, "bronze", name)
    return {name: read_table(spark, root, name) for name in names}


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """All columns of all Parquet files under a path, not only the first file's."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def land_files(spark: SparkSession, files: Mapping[str, str], root: str, table: str) -> DataFrame:
    """Land raw files of one table under a key each, and return the table.

    A file that is landed again replaces itself; files under other keys stay.
    The key is the column ``_file``, which ``drop_private`` takes off.
    """
    folder = table_path(root, "bronze", table)
    for key, path in files.items():
        read_files(spark, path).write.mode("overwrite").parquet(f"{folder}/_file={key}")
    return spark.read.option("basePath", folder).option("mergeSchema", "true").parquet(f"{folder}/_file=*")


def load_table(
    spark: SparkSession, paths: Iterable[str], root: str, layer: str, name: str, schema: StructType | None = None
) -> DataFrame:
    """Replace a table by what ``load_by_name`` reads, and report its rows."""
    write_table(load_by_name(spark, paths, schema), root, layer, name)
    return row_counts({name: read_table(spark, root, name, layer)})


def load_by_name(
    spark: SparkSession, paths: Iterable[str], target_schema: StructType | None = None
) -> DataFrame:
    """Read Parquet extracts, matching columns by name and ignoring case.

    Column order and spelling may differ from path to path; a column that a
    path lacks is null there, and files of one path may differ as paths do.
    Paths that agree are read in one scan, so the plan grows with the number
    of layouts and not of files. With a target schema the result has exactly
    its columns and types.
    """
    layouts: dict[str, tuple[StructType, list[str]]] = {}
    for path in paths:
        schema = read_files(spark, path).schema
        layouts.setdefault(schema.json(), (schema, []))[1].append(path)
    parts = [
        spark.read.schema(schema).parquet(*same).toDF(*[name.lower() for name in schema.names])
        for schema, same in layouts.values()
    ]
    loaded = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if target_schema is None:
        return loaded
    return loaded.select(
        *[
            (F.col(f.name.lower()) if f.name.lower() in loaded.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in target_schema.fields
        ]
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table, as one small table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make tables available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def drop_private(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Without the named columns and those whose name starts with an underscore."""
    hidden = [name for name in df.columns if name.startswith("_") or name in columns]
    return df.drop(*hidden)
