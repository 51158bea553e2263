"""Database sinks and sources over Spark's JDBC data source.

Connection details are passed in (URL plus properties); nothing is logged. Writes run in
parallel (``numPartitions``) – order is carried by the row-number column, not by one task.
Truncate+insert and delete+append are two database transactions (trap T7): a failure
between them leaves the table empty or the cycle missing; prefer :mod:`sluice.sinks.tables`
(partition overwrite) where the target can be a Spark table.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..errors import AUDIT_DELETE_ERROR, DATABASE_ERROR, IntakeError
from ..operators.align import align, unknown_columns
from .tables import load_rejects, quote_table

log = logging.getLogger(__name__)


def read_table(spark: SparkSession, url: str, table: str, properties: dict,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Whole-table scan.

    With a numeric ``partition_column`` the read is split into ``num_partitions`` range
    queries (default: the cluster's cores); missing bounds are found first with one small
    ``MIN``/``MAX`` query, so a large table is not read over a single connection.
    """
    if not partition_column:
        return spark.read.jdbc(url, table, properties=properties)
    if lower is None or upper is None:
        col = quote_table(partition_column)
        bounds = spark.read.jdbc(
            url, f"(SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM {table}) bounds",
            properties=properties).first()
        lower = bounds["lo"] if lower is None else lower
        upper = bounds["hi"] if upper is None else upper
        if lower is None:                       # empty table
            return spark.read.jdbc(url, table, properties=properties)
    parts = num_partitions or spark.sparkContext.defaultParallelism
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=int(lower),
                           upperBound=int(upper) + 1, numPartitions=parts,
                           properties=properties)


def target_schema(spark: SparkSession, url: str, table: str, properties: dict) -> T.StructType:
    """Column names, order and types of a database table (metadata query only)."""
    return spark.read.jdbc(url, quote_table(table), properties=properties).schema


def truncate_load(df: DataFrame, url: str, table: str, properties: dict,
                  skip: str | None = None, num_partitions: int | None = None,
                  on_cast: str = "raise", on_schema: str = "raise") -> dict[str, int]:
    """Keep the table definition, replace all rows (K1). Before that, names are checked (T6) and
    values that ``try_cast`` cannot convert to the table's types (A6) are counted, so typed targets
    do not depend on database-side string coercion; rejects raise unless ``on_cast="null"``.
    ``on_schema="warn"`` loads the columns as they are where the schema cannot be read (A7).
    Returns the rejected values per column."""
    spark, rejects = df.sparkSession, {}
    try:
        schema = target_schema(spark, url, table, properties)
    except Exception as exc:  # noqa: BLE001 - policy switch
        if on_schema != "warn":
            raise
        log.warning("alignment skipped, schema of %s not read: %s", table, exc)
        aligned = df
    else:
        extra = [c for c in unknown_columns(df, schema) if not skip or c.lower() != skip.lower()]
        if extra:
            raise IntakeError(DATABASE_ERROR, f"columns not in {table}: {extra}", table)
        rejects = load_rejects(df, schema, table, on_cast)
        aligned = align(df, schema, skip=skip, cast=True)
    w = aligned.write.option("truncate", "true").mode("overwrite")
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    w.jdbc(url, quote_table(table), properties=properties)
    return rejects


def append(df: DataFrame, url: str, table: str, properties: dict, coerce: bool = True) -> None:
    """Append; with ``coerce`` string values are typed by the database (K2)."""
    props = dict(properties)
    if coerce:
        props["stringtype"] = "unspecified"
    df.write.mode("append").jdbc(url, quote_table(table), properties=props)


def delete_key(spark: SparkSession, url: str, table: str, properties: dict, key: str,
               value: str) -> int:
    """``DELETE FROM table WHERE key = ?`` as a prepared statement (no data in SQL text)."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, str(v))
    conn = None
    try:
        conn = jvm.java.sql.DriverManager.getConnection(url, props)
        stmt = conn.prepareStatement(
            f"DELETE FROM {quote_table(table)} WHERE {quote_table(key)} = ?")
        stmt.setString(1, value)
        return stmt.executeUpdate()
    except Exception as exc:  # noqa: BLE001
        raise IntakeError(AUDIT_DELETE_ERROR, f"delete failed: {type(exc).__name__}", table) from exc
    finally:
        if conn is not None:
            conn.close()


def replace_key(df: DataFrame, url: str, table: str, properties: dict,
                key: str = "billcycle") -> None:
    """K3 on a database: delete each incoming key value, then append the rows."""
    spark = df.sparkSession
    for row in df.select(key).distinct().toLocalIterator():
        delete_key(spark, url, table, properties, key, row[0])
    append(df, url, table, properties)
