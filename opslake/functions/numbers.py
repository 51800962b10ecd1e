"""Numbers whose last bits must not depend on the order of a distributed sum."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def settled(value: Column) -> Column:
    """A mean to nine decimals, exact: partitioning can no longer move it across a limit."""
    return value.cast("decimal(30,9)")


def settled_round(value: Column, digits: int) -> Column:
    return F.round(settled(value), digits).cast("double")
