"""Row filters as boolean columns. Each one states what happens to null."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from cohortloom.functions.exprs import Col, as_col


def _certain(condition: Column) -> Column:
    """Null counts as false."""
    return F.coalesce(condition, F.lit(False))


def contains_any(c: Col, words: Sequence[str]) -> Column:
    """Text contains one of the words, any case. One pass for all words. Null text gives null."""
    if not words:
        return F.lit(False)
    return as_col(c).rlike("(?iu)" + "|".join(re.escape(w) for w in words))


def contains_none(c: Col, words: Sequence[str]) -> Column:
    """Text contains none of the words, any case. Null text gives null, so a filter drops it."""
    if not words:
        return as_col(c).isNotNull()
    return ~contains_any(c, words)


def not_listed(c: Col, values: Sequence) -> Column:
    """Value is not in a short literal list; null is kept."""
    return ~_certain(as_col(c).isin(list(values)))


def range_or_listed(c: Col, low: float, high: float, id_col: Col, ids: Sequence) -> Column:
    """low <= x < high, or x is null, or the id is one that escapes the range."""
    outside = _certain((as_col(c) < low) | (as_col(c) >= high))
    return ~outside | _certain(as_col(id_col).isin(list(ids)))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def any_at_least(cuts: Mapping[str, float]) -> Column:
    """At least one column reaches its cut."""
    return any_of([F.col(c) >= cut for c, cut in cuts.items()])


def masked_or(first: Column, second: Column, mask: Column | None = None) -> Column:
    """``first``, or ``second`` where ``mask`` holds; without a mask the plain OR. Null counts as false."""
    arm = _certain(second) if mask is None else _certain(second) & _certain(mask)
    return _certain(first) | arm


def flag_is(c: Col, value: int) -> Column:
    """Flag equals the value; null does not."""
    return _certain(as_col(c) == value)


def flag_is_not(c: Col, value: int) -> Column:
    """Flag differs from the value; null differs too."""
    return ~_certain(as_col(c) == value)
