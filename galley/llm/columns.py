"""Names and types of the columns that operators are given."""

from __future__ import annotations

from pyspark.sql import DataFrame

from galley.columns import fresh as fresh


def integral(docs: DataFrame, key: str) -> None:
    """Refuses a key that is not an integer column."""
    kind = docs.schema[key].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{key} must be an integer column, it is {kind}")
