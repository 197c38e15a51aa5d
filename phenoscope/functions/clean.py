"""Scalar cleaning expressions (P4-P8).  All are built-in Catalyst expressions,
so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the instant format of the raw extracts.
DEFAULT_INSTANT_PATTERN = "yyyy-MM-dd'T'HH:mm:ssX"

ON_ERROR_MODES = ("fail", "drop")


def _check_mode(on_error: str) -> None:
    if on_error not in ON_ERROR_MODES:
        raise ValueError(f"on_error must be one of {ON_ERROR_MODES}, got {on_error!r}")


def present(c: Column | str) -> Column:
    """A non-missing text value.  ``NULL != ''`` is NULL, so NULL is dropped too."""
    return F.col(c) != F.lit("") if isinstance(c, str) else c != F.lit("")


def lower_name(c: Column | str, on_error: str = "fail", what: str = "name") -> Column:
    """P5: lower-cased name.  A NULL name fails the job (``fail``) or becomes
    NULL for a later drop (``drop``)."""
    _check_mode(on_error)
    col = F.col(c) if isinstance(c, str) else c
    if on_error == "fail":
        return F.when(col.isNull(), F.raise_error(F.lit(f"null {what} in extract"))).otherwise(
            F.lower(col)
        )
    return F.lower(col)


def parse_number(c: Column | str, on_error: str = "fail") -> Column:
    """Number text with thousands separators → double.

    Every comma is removed before parsing.  ``fail`` uses an ANSI cast, which
    raises on text that is not a number; ``drop`` uses ``try_cast`` (NULL).
    Text ``NaN`` parses to NaN in both modes.
    """
    _check_mode(on_error)
    col = F.col(c) if isinstance(c, str) else c
    cleaned = F.regexp_replace(col, ",", "")
    if on_error == "fail":
        return cleaned.cast("double")
    return cleaned.try_cast("double")


def parse_instant(c: Column | str, pattern: str = DEFAULT_INSTANT_PATTERN,
                  on_error: str = "fail") -> Column:
    """Instant text with a zone (``Z``, ``+02``, ``+0200``) → timestamp.

    The result is an instant (TIMESTAMP), never a date: same-day events keep
    their order.
    """
    _check_mode(on_error)
    col = F.col(c) if isinstance(c, str) else c
    if on_error == "fail":
        parsed = F.to_timestamp(col, pattern)
        return F.when(
            col.isNull() | parsed.isNull(), F.raise_error(F.concat(F.lit("bad instant: "), col))
        ).otherwise(parsed)
    return F.try_to_timestamp(col, F.lit(pattern))


def epoch_millis(c: Column | str) -> Column:
    """Instant → epoch milliseconds (independent of the session time zone)."""
    return F.unix_millis(F.col(c) if isinstance(c, str) else c)
