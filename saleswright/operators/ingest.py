"""Shaping of source rows before they are stored raw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Where each raw customer column lies in the nested documents (fixed values).
CUSTOMER_PATHS = {
    "customer_code": "customer_id",
    "first_name": "personal_info.first_name",
    "last_name": "personal_info.last_name",
    "email": "contact.email",
    "phone": "contact.phone",
    "country": "address.country",
    "city": "address.city",
    "registration_date": "registration_date",
    "customer_segment": "segment",
}


def flatten_customers(df: DataFrame, *kept: str) -> DataFrame:
    """Nested customer documents to one flat row each, with the ``kept`` columns.

    A missing struct gives NULL fields, so both the short and the long form of
    the documents fit.
    """
    fields = [F.col(path).alias(name) for name, path in CUSTOMER_PATHS.items()]
    return df.select(*fields, *kept)


def add_ingestion_metadata(
    df: DataFrame, run_ts: Column, source_file: str | None = None
) -> DataFrame:
    """Ingestion time and source file.

    Without a given name the file each row was read from is recorded: the
    column ``source_file`` if ``df`` has one, else that of the file scan that
    ``df`` then has to be.
    """
    others = [c for c in df.columns if c != "source_file"]
    if source_file is not None:
        source = F.lit(source_file)
    elif len(others) < len(df.columns):
        source = F.col("source_file")
    else:
        source = F.col("_metadata.file_name")
    return df.select(*others, run_ts.alias("ingestion_timestamp"), source.alias("source_file"))


def add_default_columns(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill columns that are absent; a NULL that is present stays NULL."""
    absent = {name: value for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df
