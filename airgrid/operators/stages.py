"""Columns computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def staged(df: DataFrame, **columns: Column) -> DataFrame:
    """df with the columns added, each evaluated once for a row.

    A plain projection is merged into the next one, which repeats its expressions for every use; a generator of one
    row is not.
    """
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))
