"""Names of helper columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until ``df`` has no such column
    (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
