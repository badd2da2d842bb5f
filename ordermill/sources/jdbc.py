"""JDBC tables and pushed-down queries (O-05..O-07 over JDBC).

Reads push a whole SQL query to the database (``query`` option), as the
reference does for its high-water mark. Writes use one connection per
partition; size ``num_partitions`` to what the database accepts.
Spark quotes column names when it creates a table but not the table name, so
in pushed queries quote the columns and leave the table name as written
(some databases fold unquoted names to upper case).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc_query(spark: SparkSession, url: str, query: str, props: dict | None = None,
                    partition_column: str | None = None, lower: int | None = None,
                    upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A SQL query run by the database, as a DataFrame (O-07).

    A plain query is one JDBC connection, so one Spark partition: right for
    small results such as a high-water mark. For a large result pass a numeric
    ``partition_column`` of the query's output with bounds: the query is then
    read as a subquery in ``num_partitions`` ranges on parallel connections
    (the bounds only set the stride; rows outside them go to the first and
    last range, none is dropped).
    """
    r = spark.read.format("jdbc").option("url", url)
    if partition_column:
        r = (r.option("dbtable", f"({query}) q")
             .option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    else:
        r = r.option("query", query)
    for k, v in (props or {}).items():
        r = r.option(k, v)
    return r.load()


def read_jdbc_table(spark: SparkSession, url: str, table: str, props: dict | None = None,
                    partition_column: str | None = None, lower: int | None = None,
                    upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A table over JDBC; with a partition column the read is split in ranges."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    for k, v in (props or {}).items():
        r = r.option(k, v)
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str, props: dict | None = None,
               num_partitions: int | None = None, batch_size: int = 10000) -> None:
    """Overwrite a staging table (``mode="overwrite"``, O-05) or append rows
    (``mode="append"``, O-06)."""
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", batch_size).mode(mode))
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in (props or {}).items():
        w = w.option(k, v)
    w.save()
