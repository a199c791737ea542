"""Name a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row.

    An expression used several times, above all inside a lambda, is otherwise computed at
    every use.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
