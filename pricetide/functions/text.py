"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that mean "missing" in a feed (exact, before any trim).
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Unicode white space; U+200B (zero width space) is not part of it.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def missing_as_null(name: str) -> Column:
    """A text column with NULL where the whole cell is one of the missing-value tokens."""
    tokens = ", ".join(f"'{token}'" for token in MISSING_TOKENS)
    return F.expr(f"if(`{name}` in ({tokens}), null, `{name}`)")


def strip(column: Column) -> Column:
    """Remove Unicode white space from both ends (plain ``trim`` removes U+0020 only).

    ``btrim`` looks up characters one by one, a large part of the time of cleaning. Text whose
    first and last byte are printable ASCII has no white space at its ends and skips it.
    """
    begins = (column >= "!") & (column < "\x7f")
    ends = F.substring(column.cast("binary"), -1, 1).between(F.lit(b"!"), F.lit(b"~"))
    return F.when(begins & ends, column).otherwise(F.btrim(column, F.lit(WHITESPACE)))


def fill_blank(column: Column) -> Column:
    """Stripped text with NULL as the empty string, so that it can be an equality key."""
    return F.coalesce(strip(column), F.lit(""))
