"""Small column helpers shared by the text functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def contains_any(text: Column, needles: Iterable[str]) -> Column:
    return reduce(or_, (F.contains(text, F.lit(needle)) for needle in needles))
