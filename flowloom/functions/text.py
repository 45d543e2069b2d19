"""Text expressions that stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space at either end; any Unicode white space counts, line ends and no-break spaces too."""
    return F.regexp_replace(_col(c), r"(?U)^\s++|(?<!\s)\s++$", "")  # linear, however long a run of blanks is


def blank_to_null(c: Column | str) -> Column:
    """Stripped text; null when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def folded(c: Column | str) -> Column:
    """Stripped lower-case text, null when blank: how codes and database names are compared."""
    return F.lower(blank_to_null(c))


def number(c: Column | str) -> Column:
    """A double in which NaN is null."""
    c = _col(c).cast("double")
    return F.when(~F.isnan(c), c)


def alnum_key(c: Column) -> Column:
    """Letters and digits in lower case; any run of other characters is one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def month(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")
