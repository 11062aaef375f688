"""Table references in SQL statement text.

These are column expressions over one text column. They see text, not grammar: names of
common table expressions count as tables, only the name right after FROM / JOIN is read,
and text inside string literals is scanned too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.fixed_values import SQL_STOP_WORDS
from tributary.functions.text import WHITE

# A back-ticked or plain name, captured with its ticks; ticks cannot occur inside.
NAME = r"(`[^`]+`|[A-Za-z_][A-Za-z0-9_\-]*)"
OUTPUT_PATTERN = (
    rf"(?iU)(?:INSERT{WHITE}+INTO|CREATE{WHITE}+TABLE{WHITE}+"
    rf"(?:IF{WHITE}+NOT{WHITE}+EXISTS{WHITE}+)?){WHITE}*{NAME}"
)


def _read_pattern(keyword: str) -> str:
    return rf"(?iU)(?<!\w){keyword}{WHITE}+{NAME}"


def _names(sql: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(sql, F.lit(pattern), F.lit(1))
    return F.transform(found, lambda n: F.translate(n, "`", ""))


def strip_sql_comments(sql: Column) -> Column:
    no_lines = F.regexp_replace(sql, r"--[^\n]*", " ")
    return F.regexp_replace(no_lines, r"(?s)/\*.*?\*/", " ")


def extract_outputs(stripped: Column) -> Column:
    """Names written, in text order, duplicates kept."""
    return _names(stripped, OUTPUT_PATTERN)


def drop_keywords(names: Column) -> Column:
    return F.filter(names, lambda n: ~F.upper(n).isin(*SQL_STOP_WORDS))


def extract_inputs(stripped: Column) -> Column:
    """Names after FROM, then names after JOIN, each in text order."""
    both = F.concat(_names(stripped, _read_pattern("FROM")), _names(stripped, _read_pattern("JOIN")))
    return drop_keywords(both)


def drop_self_references(inputs: Column, outputs: Column) -> Column:
    """Inputs that are not also outputs; duplicates among the rest are kept."""
    return F.filter(inputs, lambda n: ~F.array_contains(outputs, n))
