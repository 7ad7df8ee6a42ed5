"""Column parsers for dirty text columns.

The source analytics update text columns in place and then change their
type.  Here each step is a pure Column expression; a cleaned DataFrame is
a new projection of the raw one.

Two modes decide what a blank string becomes when a text column is turned
into a number or a time:

* ``reference`` (default): blank converts to 0 / 0.0 / 1900-01-01, as the
  in-place type change of the source does.
* ``strict``: blank becomes NULL.

Real NULLs stay NULL in both modes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semantics import ColumnOrName, _c

REFERENCE = "reference"
STRICT = "strict"

# The text that marks a missing value in the raw tables, and
# the time a blank converts to in reference mode.
NULL_TEXT = "null"
BLANK_TIME = "1900-01-01 00:00:00"

# The units that are removed behind a number.  What is left
# must be a number as a whole.
NUMBER_PATTERN = r"(?i)^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?)\s*(?:km)?\s*$"
INTEGER_PATTERN = r"(?i)^\s*([+-]?\d+)\s*(?:minutes|minute|mins|min)?\s*$"


def _check_mode(mode: str) -> None:
    if mode not in (REFERENCE, STRICT):
        raise ValueError(f"mode must be {REFERENCE!r} or {STRICT!r}, got {mode!r}")


def blank_or_null_text(c: Column) -> Column:
    """'' or the text 'null' (any case, blanks around); NULL for NULL input."""
    return F.lower(F.trim(c)).isin("", NULL_TEXT)


def blank_null_like(col: ColumnOrName) -> Column:
    """NULL, the text 'null' (any case) or only blanks -> '' ; other values
    unchanged (C1, C3, M6)."""
    c = _c(col)
    return F.when(F.coalesce(F.lower(F.trim(c)), F.lit("")).isin("", NULL_TEXT),
                  F.lit("")).otherwise(c)


# The parsers below take the raw text and fold the 'null'-text step
# in: 'null' and '' are both "blank".  Each references its input only
# twice, so when Catalyst pushes a filter on a cleaned column below the
# projection (substituting the expression), the predicate stays small.

def parse_number(col: ColumnOrName, mode: str = REFERENCE) -> Column:
    """A decimal number, with or without its unit behind it ('13.4 km') -> double (C4).

    Blank or 'null' text -> 0.0 (reference) / NULL (strict); NULL -> NULL;
    text that is not a number as a whole -> NULL.
    """
    _check_mode(mode)
    c = _c(col)
    parsed = F.nullif(F.regexp_extract(c, NUMBER_PATTERN, 1), F.lit("")).try_cast("double")
    if mode == REFERENCE:
        return F.coalesce(parsed, F.when(blank_or_null_text(c), F.lit(0.0)))
    return parsed


def parse_int(col: ColumnOrName, mode: str = REFERENCE) -> Column:
    """'32 minutes', '15 minute', '20mins', '10' -> int.

    Blank or 'null' text -> 0 (reference) / NULL (strict); NULL -> NULL;
    text that is not a whole number as a whole -> NULL.
    """
    _check_mode(mode)
    c = _c(col)
    parsed = F.nullif(F.regexp_extract(c, INTEGER_PATTERN, 1), F.lit("")).try_cast("int")
    if mode == REFERENCE:
        return F.coalesce(parsed, F.when(blank_or_null_text(c), F.lit(0)))
    return parsed


def parse_ts(col: ColumnOrName, mode: str = REFERENCE) -> Column:
    """Text -> timestamp_ntz.

    Blank or 'null' text -> 1900-01-01 00:00:00 (reference) / NULL (strict);
    unparseable text and NULL -> NULL.
    """
    _check_mode(mode)
    c = _c(col)
    parsed = c.try_cast("timestamp_ntz")
    if mode == REFERENCE:
        return F.coalesce(parsed, F.when(blank_or_null_text(c),
                                         F.lit(BLANK_TIME).cast("timestamp_ntz")))
    return parsed


LIST_SEPARATOR = r" *, *"


def list_items(col: ColumnOrName) -> Column:
    """Comma-separated text -> array of space-trimmed items.

    A blank text has no items; an item of a text that is not blank may be
    empty and is kept.  ``split`` on a separator that absorbs surrounding
    blanks is a code-generated built-in, no per-element lambda.
    """
    c = F.trim(_c(col))
    none = F.slice(F.array(F.lit("")), 1, 0)  # typed as the split is: its items are never NULL
    return F.when(c == "", none).otherwise(F.split(c, LIST_SEPARATOR))
