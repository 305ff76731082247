"""Warehouse tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class KeyRange:
    """How to split a read: ``parts`` queries over a numeric column's range."""

    column: str
    lower: int
    upper: int
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


@dataclass(frozen=True)
class JdbcWarehouse:
    """A database that holds the warehouse; ``properties`` carry user and driver."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)

    def read_options(self, table: str, split: KeyRange | None = None) -> dict[str, str]:
        options = {"url": self.url, "dbtable": table, **self.properties}
        return options | (split.options() if split else {})

    def write_options(self, table: str, writers: int, batch: int = 10_000) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": table,
            **self.properties,
            "batchsize": str(batch),
            "numPartitions": str(writers),
        }

    def read(
        self,
        spark: SparkSession,
        table: str,
        columns: Sequence[str],
        split: KeyRange | None = None,
    ) -> DataFrame:
        """Some columns of a table; columns and filters reach the database."""
        reader = spark.read.format("jdbc").options(**self.read_options(table, split))
        return reader.load().select(*columns)

    def replace(self, df: DataFrame, table: str, writers: int) -> None:
        """Empty the table, keeping its definition, and fill it with ``df``.

        A database refuses this for a table that others reference; there, load a
        staging table and merge it. ``df`` is dealt over as many tasks as may
        write at a time, so that the plan before keeps its own partitions.
        """
        options = self.write_options(table, writers)
        df.repartition(writers).write.format("jdbc").mode("overwrite").options(**options, truncate="true").save()

    def append(self, df: DataFrame, table: str, writers: int) -> None:
        """Add ``df``. Drop rows the table already has first: a retried task may
        send a batch twice, so the table should also declare its key unique."""
        options = self.write_options(table, writers)
        df.repartition(writers).write.format("jdbc").mode("append").options(**options).save()
