"""Boolean helpers for rule conditions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column


def null_or_zero(value: Column) -> Column:
    return value.isNull() | (value == 0)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions)
