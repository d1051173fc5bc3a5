"""Dates that arrive as text, and calendar lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltledger.functions.predicates import differs


# The parts of a date in either spelling; any other text matches with none of them.
SPELLINGS = r"(?s)^(?:(\d{4})-(\d{2})-(\d{2})|(\d{2})/(\d{2})/(\d{4})|.*)\z"
YEAR_MONTH_DAY = "$1$6-$2$5-$3$4"


def parse_date(c: Column) -> Column:
    """A date from text that is wholly ``2010-02-26`` or ``26/02/2010``.

    These are the two spellings of the register files. Any other text gives null, as does a day
    that the calendar lacks; a date column passes through. The column is named once, so that what
    it is made of is worked out once. Casts that fail here cost no exception, unlike a failed
    format.
    """
    return F.regexp_replace(c.cast("string"), SPELLINGS, YEAR_MONTH_DAY).try_cast("date")


def is_unreadable_date(c: Column) -> Column:
    """There is a text, and ``parse_date`` makes nothing of it; never null."""
    return c.isNotNull() & parse_date(c).isNull()


def spelled_alike(c: Column) -> Column:
    """A date in its ISO spelling; any other text as it is."""
    return F.coalesce(parse_date(c).cast("string"), c.cast("string"))


def dates_differ(a: Column, b: Column) -> Column:
    """Not the same date where both are dates, otherwise not the same text; null equals null.

    A date and a text that is none never have the same spelling, so one comparison does.
    """
    return differs(spelled_alike(a), spelled_alike(b))


def days_between(first: Column, last: Column) -> Column:
    """Calendar days from ``first`` to ``last``, both counted, leap days included."""
    return F.datediff(last, first) + 1
