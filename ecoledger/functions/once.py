"""Expressions that are evaluated once, however often they are named."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def pinned(value: Column) -> Column:
    """``value``, kept where it is computed.

    The optimizer copies expressions into every filter and projection above them, also into
    filters that it makes up for an explode. It does not copy what may differ from call to
    call, and the number of a partition counts as that.
    """
    return F.when(F.spark_partition_id() >= 0, value)
