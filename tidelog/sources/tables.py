"""Catalog tables and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def permanent_tables(spark: SparkSession, schema: str, fallback: list[str]) -> list[str]:
    """Table names of a schema without temporary views; the fallback if it cannot be listed."""
    if not spark.catalog.databaseExists(schema):
        return fallback
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)


def create_or_replace(rows: DataFrame, table: str) -> None:
    rows.write.mode("overwrite").format("parquet").saveAsTable(table)


def create_if_absent(spark: SparkSession, rows: DataFrame, table: str) -> bool:
    if spark.catalog.tableExists(table):
        return False
    rows.write.format("parquet").saveAsTable(table)
    return True


def insert_overwrite(rows: DataFrame, table: str) -> None:
    """Replace the rows of an existing table, matching columns by name."""
    spark = rows.sparkSession
    rows.select(spark.table(table).columns).write.insertInto(table, overwrite=True)


def as_view(rows: DataFrame, name: str) -> None:
    rows.createOrReplaceTempView(name)
