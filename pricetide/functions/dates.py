"""ISO-8601 text to UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts Spark's cast reads as they are. On its own that cast also takes bare times (as of
# today), six-digit years and zone names, which are not observations.
_ZONE = r"(Z|[+-]\d{2}(:?\d{2})?)?"
_TIME = r"\d{1,2}(:\d{2}(:\d{2}([.]\d+)?)?)?"
EXTENDED = rf"^\d{{4}}(-\d{{1,2}}(-\d{{1,2}}([T ]{_TIME}{_ZONE})?)?)?$"
# Compact or slashed dates and compact times, which are rewritten to the extended form.
COMPACT = rf"^(\d{{4}}/?\d{{2}}/?\d{{2}}|\d{{4}}-\d{{1,2}}-\d{{1,2}})([T ](\d{{6}}([.]\d+)?|{_TIME}){_ZONE})?$"
COMPACT_DATE = r"^(\d{4})/?(\d{2})/?(\d{2})(?=$|[T ])"
COMPACT_TIME = r"([T ])(\d{2})(\d{2})(\d{2})"
# One microsecond beyond what a 64-bit nanosecond clock can hold.
TOO_EARLY = "1677-09-21 00:12:43.145223"
TOO_LATE = "2262-04-11 23:47:16.854776"


def iso_instant(text: Column) -> Column:
    """Text as a timestamp, NULL when it is not an ISO-8601 instant in range.

    Text without a zone is UTC, which needs the session time zone to be UTC. The cast
    appears once in the expression, since it is the costly part of cleaning a feed.
    """
    rewritten = F.regexp_replace(
        F.regexp_replace(text, COMPACT_DATE, "$1-$2-$3"), COMPACT_TIME, "$1$2:$3:$4"
    )
    accepted = F.when(text.rlike(EXTENDED), text).when(text.rlike(COMPACT), rewritten)
    early, late = (F.lit(bound).cast("timestamp") for bound in (TOO_EARLY, TOO_LATE))
    # Anything out of range (and NULL, which least and greatest skip) ends on a bound.
    clamped = F.greatest(F.least(accepted.try_cast("timestamp"), late), early)
    return F.nullif(F.nullif(clamped, late), early)
