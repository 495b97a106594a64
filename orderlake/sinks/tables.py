"""Publishing tables in the catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def materialise(frame: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Create table as select, replacing an older one: scan once, read the summary often.

    With a path the rows are written there before the name points to them.
    """
    spark = frame.sparkSession
    writer = frame.write.mode("overwrite").option("compression", "snappy")
    if path:
        writer.parquet(path)
        return publish_table(spark, table, path, frame.schema, statistics="table")
    writer.format("parquet").saveAsTable(table)
    return spark.table(table)


def _columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def publish_table(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType,
    *,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    statistics: str | None = "columns",
) -> DataFrame:
    """Declare an external table over a directory, recover its partitions, gather statistics.

    ``statistics``: "columns" for all columns, "table" for size and rows only,
    None to skip. Column statistics read the data once; on a large lake "table" is
    the cheap choice and already lets the optimizer size a join side. An external table of
    that name is replaced; a managed one is refused, since dropping it would delete its rows.
    """
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType == "MANAGED":
            raise ValueError(f"{table} is a managed table; drop it yourself to replace it")
        spark.sql(f"DROP TABLE {table}")
    tree = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    settings = ", ".join(f"'{key}' '{value}'" for key, value in (options or {}).items())
    reader = f"OPTIONS ({settings})" if settings else ""
    spark.sql(
        f"CREATE TABLE {table} ({_columns_ddl(schema)}) "
        f"USING {fmt} {reader} {tree} LOCATION '{path}'"
    )
    if partition_by:
        spark.catalog.recoverPartitions(table)
    if statistics:
        columns = " FOR ALL COLUMNS" if statistics == "columns" else ""
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{columns}")
    return spark.table(table)
