"""Predicates over event names and values.

Code sets are bounded (a profile holds at most a few dozen terms), so
membership is an ``IN`` over literals, which Catalyst turns into a hashed
``InSet`` evaluated inside codegen: no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.criteria import ABNORMAL_LAB_RULES, GLUCOSE_TEST_MARKER

_OPS = {
    ">=": lambda v, t: v >= t,
    ">": lambda v, t: v > t,
    "<=": lambda v, t: v <= t,
    "<": lambda v, t: v < t,
    "=": lambda v, t: v == t,
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_code_set(c: Column | str, terms: Iterable[str]) -> Column:
    """Exact, case-sensitive membership."""
    return _col(c).isin(list(terms))


def has_prefix(c: Column | str, prefixes: Iterable[str]) -> Column:
    """P10: the first ``len(prefix)`` characters equal the prefix."""
    col = _col(c)
    conds = [F.substring(col, 1, len(p)) == F.lit(p) for p in prefixes]
    out = F.lit(False)
    for cond in conds:
        out = out | cond
    return out


def in_set_or_prefix(c: Column | str, terms: Iterable[str], prefixes: Iterable[str]) -> Column:
    """P9 ∨ P10, as the DM-related diagnosis rule uses it."""
    return in_code_set(c, terms) | has_prefix(c, prefixes)


def contains_text(c: Column | str, marker: str = GLUCOSE_TEST_MARKER) -> Column:
    """The name contains ``marker`` (case-sensitive, names are lower-cased)."""
    return _col(c).contains(marker)


def abnormal_lab(name: Column | str, value: Column | str, rules=ABNORMAL_LAB_RULES) -> Column:
    """The value breaks the threshold rule of its test.

    The rule table is a handful of fixed rows, so it is folded into one
    disjunction instead of a join.
    """
    n, v = _col(name), _col(value)
    out = F.lit(False)
    for test_name, op, threshold in rules:
        out = out | ((n == F.lit(test_name)) & _OPS[op](v, F.lit(float(threshold))))
    return out
