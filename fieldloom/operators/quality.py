"""Key constraints as queries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_key_violations(df: DataFrame, keys: Sequence[str], allow_null: bool = False) -> DataFrame:
    """Keys that break uniqueness: the keys and ``n``, the rows that share them.

    A primary key also forbids NULL, so a key with a NULL part is reported even
    when it stands alone.  ``allow_null=True`` is a plain UNIQUE, under which keys
    with a NULL part never clash.
    """
    some_null = reduce(or_, [F.col(k).isNull() for k in keys])
    counted = df.groupBy(*keys).agg(F.count("*").alias("n"))
    if allow_null:
        return counted.where((F.col("n") > 1) & ~some_null)
    return counted.where((F.col("n") > 1) | some_null)
