"""Null-safe casts and text normalisation for all-string extracts.

ANSI mode stays on: nothing here can raise on bad data, every unparseable value becomes NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = "decimal(38,9)"

# The text layouts the feeds may use for dates and date-times.
ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}\z"
ISO_DATETIME = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?)?\z"
DMY_DATE = r"^(\d{1,2})/(\d{1,2})/(\d{4})\z"
DMY_DATETIME = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}:\d{1,2}:\d{1,2})\z"

# The words that mean true and false.
TRUE_WORDS = ("yes", "true", "1")
FALSE_WORDS = ("no", "false", "0")


# Shape of number texts: a cast alone would also read type suffixes (12.5d) and hexadecimal floats.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"
NOT_FINITE = r"(?i)^\s*([+-]?inf(inity)?|nan)\s*\z"
EDGE_SPACE = r"^[\s\x{85}\p{Z}]+|[\s\x{85}\p{Z}]+\z"


def safe_cast(col: Column, dtype: str) -> Column:
    """Cast, or NULL where the text cannot be read as ``dtype``."""
    if dtype in ("double", "float"):
        return F.when(col.rlike(NUMBER) | col.rlike(NOT_FINITE), col.try_cast(dtype))
    if dtype.startswith("decimal"):
        return F.when(col.rlike(NUMBER), col.try_cast(dtype))
    return col.try_cast(dtype)


def trim_all(col: Column) -> Column:
    """Without white space of any kind at both ends: tabs, line ends and no-break spaces too."""
    return F.regexp_replace(col, EDGE_SPACE, "")


def blank_to_null(col: Column, trim: bool = True) -> Column:
    """NULL for the empty string; with ``trim`` also for white space only."""
    return F.nullif(trim_all(col) if trim else col, F.lit(""))


def norm(col: Column, case: str | None = None, trim: bool = True) -> Column:
    """Trim and optionally fold the case (``"upper"`` or ``"lower"``)."""
    out = trim_all(col) if trim else col
    return {None: out, "upper": F.upper(out), "lower": F.lower(out)}[case]


def parse_datetime(col: Column, day_first: bool = True) -> Column:
    """ISO date-time, else ``dd/mm/yyyy hh:mm:ss``, else NULL; a zone-free timestamp.

    Day-first text is rewritten to ISO so that one zone-free cast serves both layouts; the result
    does not depend on the session time zone.  The layout test keeps out the partial dates
    (``2025``, ``2025-07``) which a Spark cast alone would accept.
    """
    iso = F.regexp_replace(col, DMY_DATETIME, "$3-$2-$1 $4") if day_first else col
    return F.when(iso.rlike(ISO_DATETIME), iso.try_cast("timestamp_ntz"))


def parse_date(col: Column, day_first: bool = True) -> Column:
    """ISO date, else ``dd/mm/yyyy``, else NULL."""
    iso = F.regexp_replace(col, DMY_DATE, "$3-$2-$1") if day_first else col
    return F.when(iso.rlike(ISO_DATE), iso.try_cast("date"))


def parse_bool(col: Column) -> Column:
    """yes/true/1 and no/false/0 in any case, else NULL."""
    word = norm(col, "lower")
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def correct_enum(value: Column, allowed: Sequence[str], derived: Column) -> Column:
    """Replace a value outside ``allowed`` by ``derived``.  NULL stays NULL."""
    return F.when(~value.isin(*allowed), derived).otherwise(value)


def impute_label(col: Column, label: str = "UNKNOWN") -> Column:
    return F.coalesce(col, F.lit(label))


def stable_round(col: Column, places: int = 2) -> Column:
    """Round half away from zero, unaffected by the order in which doubles were added.

    Going through a 9-place decimal removes the last-bit noise of distributed sums before the
    rounding decision is made, so the same data gives the same cents on any number of tasks.
    """
    return F.round(col.try_cast(NUMERIC), places).cast("double")
