"""Parting a delivery into rows that a table takes and rows that break its constraints."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.operators.cleaning import first_defect
from saleswright.operators.joins import join_on_text
from saleswright.schemas import ColumnSpec

#: Outcome of the rows that break nothing.
STORED = "stored"


def declared_rules(df: DataFrame, specs: Iterable[ColumnSpec]) -> dict[str, Column]:
    """The conditions that a table's columns declare, by the name of the defect.

    Values are judged before they are cast to the table's types. A required
    column that is absent, and has no default, is missing in every row.
    """
    rules: dict[str, Column] = {}
    for s in specs:
        present = s.name in df.columns
        value = F.col(s.name) if present else F.lit(None)
        if s.required and (present or s.default is None):
            rules[f"missing_{s.name}"] = value.isNotNull()
        if present and s.length is not None:
            rules[f"overlong_{s.name}"] = value.isNull() | (F.char_length(value) <= s.length)
        if present and isinstance(s.type, T.DecimalType):
            rules[f"overflowing_{s.name}"] = value.isNull() | value.try_cast(s.type).isNotNull()
    return rules


def judge(
    df: DataFrame,
    specs: Iterable[ColumnSpec],
    parents: Mapping[str, tuple[DataFrame, str, str]] | None = None,
) -> DataFrame:
    """Rows with their ``outcome``: ``stored``, or the first rule that they break.

    ``parents`` maps the name of a defect to a dimension, the key that rows must
    have there and the id column that is added from it; the key is unique there.
    References are looked at first, then the columns in the table's order. A NULL
    key refers to nothing. Every row comes out once.
    """
    rules: dict[str, Column] = {}
    for defect, (parent, key, id_column) in (parents or {}).items():
        df = join_on_text(df, parent.select(key, id_column), key, "left")
        rules[defect] = F.col(id_column).isNotNull()
    rules |= declared_rules(df, specs)
    return df.withColumn("outcome", F.coalesce(first_defect(rules), F.lit(STORED)))
