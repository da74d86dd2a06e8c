"""Evaluate an expensive column once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters cannot pull below itself.

    Catalyst moves a filter through a projection by repeating the projected
    expressions in it; it does not move one through a generator that makes the
    filtered column. Exploding a one-element array is such a generator.
    """
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, F.explode(F.array(value)).alias(name))
