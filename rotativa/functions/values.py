"""Expressions that use a value several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it.

    Column expressions are trees: naming a costly one twice computes it twice,
    and array functions are not shared by the optimizer.  As the element of a
    list of one, the value is bound to a variable.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
