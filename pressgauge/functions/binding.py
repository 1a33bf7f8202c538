"""Evaluate an expression once and use the value many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a single evaluation of ``value``, also inside other lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
