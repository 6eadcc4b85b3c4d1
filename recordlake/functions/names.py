"""Two ways to turn camelCase into snake_case, for names and for values.

The name forms run on the driver while a plan is built; the column forms are
built-in expressions. Both use the same patterns, so they agree.
"""

from __future__ import annotations

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide the column names users see.
CAPITAL = r"(\p{Lu})"
WORD_START = r"(.)([A-Z][a-z]+)"
WORD_END = r"([a-z0-9])([A-Z])"


def snake_case(name: str) -> str:
    """``_`` before every capital: ``someCAPS`` -> ``some_c_a_p_s``."""
    return regex.sub(CAPITAL, r"_\1", name).lower().lstrip("_")


def camel_to_snake(name: str) -> str:
    """Acronym-aware: ``someHTTPCode`` -> ``some_http_code``."""
    return regex.sub(WORD_END, r"\1_\2", regex.sub(WORD_START, r"\1_\2", name)).lower()


def snake_case_value(text: Column) -> Column:
    return F.ltrim(F.lower(F.regexp_replace(text, CAPITAL, "_$1")), F.lit("_"))


def camel_to_snake_value(text: Column) -> Column:
    words = F.regexp_replace(text, WORD_START, "$1_$2")
    return F.lower(F.regexp_replace(words, WORD_END, "$1_$2"))


def quoted(*parts: str) -> str:
    """A column path whose parts may hold dots, spaces or backticks."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)
