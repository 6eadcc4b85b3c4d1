"""Timestamp parsing and formatting. Text that does not parse becomes null."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns records carry.
MILLIS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
SECONDS_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DATE_ONLY = "yyyy-MM-dd"
MIDNIGHT_SUFFIX = "T00:00:00.000Z"

# The shape a text must have to match each pattern. Letters match in either
# case. Only years that a timestamp holds from end to end are let in, -290307 to
# 294246: others can overflow it, which raises even where a failed parse gives
# null.
_LATE = r"\+(?:\d{5}|1\d{5}|2[0-8]\d{4}|29[0-3]\d{3}|294[01]\d{2}|2942[0-3]\d|29424[0-6])"
_EARLY = r"-(?:\d{4,5}|1\d{5}|2[0-8]\d{4}|290[0-2]\d{2}|29030[0-7])"
_DAY = rf"(?:\d{{4}}|{_LATE}|{_EARLY})-\d{{2}}-\d{{2}}"
_SHAPES = {
    MILLIS_Z: rf"^{_DAY}[Tt]\d{{2}}:\d{{2}}:\d{{2}}\.\d{{1,3}}[Zz]$",
    SECONDS_Z: rf"^{_DAY}[Tt]\d{{2}}:\d{{2}}:\d{{2}}[Zz]$",
    DATE_ONLY: rf"^{_DAY}$",
}


def parse_timestamp(text: Column, *patterns: str) -> Column:
    """The first pattern that parses wins; null when none does (also under ANSI).

    Where a pattern's shape is known it is tested first: a failed parse costs
    an exception per row, and trying patterns in turn means many of them. The
    session must use the CORRECTED time parser policy, as ``lake_session`` does.
    """
    parsed = [_parse(text, pattern) for pattern in patterns]
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


def _parse(text: Column, pattern: str) -> Column:
    parsed = F.try_to_timestamp(text, F.lit(pattern))
    shape = _SHAPES.get(pattern)
    return parsed if shape is None else F.when(text.rlike(shape), parsed)


def format_timestamp(moment: Column, pattern: str = MILLIS_Z) -> Column:
    return F.date_format(moment, pattern)


def load_stamp(as_of: str | datetime.datetime | None = None) -> Column:
    """The load time as text; pass ``as_of`` for reproducible output."""
    moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return format_timestamp(moment)


def date_parts(moment: Column) -> dict[str, Column]:
    """Zero-padded text parts, as used in directory names."""
    return {
        "year": F.date_format(moment, "yyyy"),
        "month": F.date_format(moment, "MM"),
        "day": F.date_format(moment, "dd"),
    }
