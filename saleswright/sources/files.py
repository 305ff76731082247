"""File scans. Schemas are given, so no pass over the data is spent on inference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.schemas import (
    CUSTOMERS_JSON,
    PRODUCTS_CSV,
    SALES_CSV,
    SUPPLIERS_CSV,
    WIDE_SALES_CSV,
)
from saleswright.sources.json_arrays import read_json_arrays


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, matched to ``schema`` by position.

    Columns beyond the schema are dropped and an unreadable value becomes NULL,
    so wide files load as well.
    """
    return spark.read.schema(schema).option("header", True).csv(path)


def read_sales_csv(spark: SparkSession, path: str, wide: bool = False) -> DataFrame:
    """Sales; ``wide`` also reads the columns that only wide files have."""
    return read_csv(spark, path, WIDE_SALES_CSV if wide else SALES_CSV)


def read_products_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, PRODUCTS_CSV)


def read_suppliers_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, SUPPLIERS_CSV)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and types found from the data; reads the data twice."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_customers_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = CUSTOMERS_JSON,
    document_per_line: bool = False,
    file_column: str | None = None,
) -> DataFrame:
    """Customer documents: an array of objects per file, or one object per line.

    Both are read by byte ranges, whatever the number of files; see
    :mod:`saleswright.sources.json_arrays`. ``file_column`` adds the name of the
    file a document is from. ``schema=None`` infers the fields, and then a file
    that holds an array is read by one task.
    """
    if schema is not None and not document_per_line:
        return read_json_arrays(spark, path, schema, file_column)
    reader = spark.read.option("multiLine", not document_per_line)
    documents = (reader if schema is None else reader.schema(schema)).json(path)
    if file_column is None:
        return documents
    return documents.select("*", F.col("_metadata.file_name").alias(file_column))


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A Parquet table of any layer, down to the columns wanted.

    With a schema the table may be empty and no file is opened to learn it.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.parquet(path)
    return table if columns is None else table.select(*columns)


def spread(df: DataFrame, by: Sequence[str], parts: int | None = None) -> DataFrame:
    """Deal a scan that comes in few pieces over ``parts`` tasks, or as many as AQE finds fit.

    A Parquet row group, a JSON array or a compressed CSV file is read by one
    task, and without a shuffle that task also does all the work that follows.
    ``by`` names columns of many values: a hash of them is even and, unlike a
    round-robin shuffle, needs no sort to be repeatable. The key of a join or
    grouping that follows saves that one its own shuffle. Rows are always moved, so
    a table of many pieces should be read without this.
    """
    return df.repartition(*by) if parts is None else df.repartition(parts, *by)
