"""Binding a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once a row.

    The optimizer may put a column's defining expression wherever the column is used; inside a higher-order function that
    means once for each element. A value bound as a lambda's variable stays computed.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
