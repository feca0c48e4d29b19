"""Dates and times in texts of unknown format.

The parts are rewritten to one notation by an anchored pattern and cast once,
instead of trying one parser after another; all of it stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"(\d{4})(?:-|/|\.|年)(\d{1,2})(?:-|/|\.|月)(\d{1,2})日?"
_TIME = r"(\d{1,2})[:时](\d{1,2})"
_SECOND = r"[:分](\d{1,2})秒?(\.\d{1,9})?"


def _first(text: Column, kind: str, rules: list[tuple[str, str]]) -> Column:
    out = F.lit(None).cast(kind)
    for pattern, to in reversed(rules):
        out = F.when(text.rlike(f"^{pattern}$"), F.regexp_replace(text, f"^{pattern}$", to).try_cast(kind)).otherwise(out)
    return out


def parse_datetime(text: Column) -> Column:
    """A timestamp without zone; null where no format fits.  Digits past microseconds are cut."""
    return _first(text, "timestamp_ntz", [(rf"{_DATE}[ T]{_TIME}{_SECOND}", "$1-$2-$3 $4:$5:$6$7"), (rf"{_DATE}[ T]{_TIME}分?", "$1-$2-$3 $4:$5:00"), (r"(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})(\.\d{1,9})?", "$1-$2-$3 $4:$5:$6$7")])


def parse_date(text: Column) -> Column:
    return _first(text, "date", [(_DATE, "$1-$2-$3"), (r"(\d{4})(\d{2})(\d{2})", "$1-$2-$3")])


#: Times of two digits a part, with or without milliseconds.
_CLOCK = r"([01]\d|2[0-3]):([0-5]\d):([0-5]\d(?:\.\d{3})?)"


def parse_time(text: Column) -> Column:
    """A time of day as the interval since midnight, which added to a date gives a timestamp; null where no format fits."""
    part = lambda i: F.regexp_extract(text, f"^{_CLOCK}$", i)
    fits = text.rlike(f"^{_CLOCK}$")
    return F.when(fits, F.make_dt_interval(F.lit(0), F.when(fits, part(1)).cast("int"), F.when(fits, part(2)).cast("int"), F.when(fits, part(3)).cast("decimal(18,6)")))
