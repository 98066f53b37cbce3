"""Text expressions: white-space, item codes, surrogate keys, file ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelattice import vocabulary as V


def collapse_whitespace(c: Column) -> Column:
    """Every run of white space (line breaks and NBSP too) becomes one blank; ends trimmed."""
    return F.trim(F.regexp_replace(c, V.WHITESPACE_RUN, " "))


def clean_text(c: Column) -> Column:
    """Standard form of a text cell: never null, collapsed, lower-case."""
    return F.lower(collapse_whitespace(F.coalesce(c, F.lit(""))))


def capitalize_first(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(c.substr(F.lit(2), F.length(c))))


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the parts joined by '|', null parts skipped."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def file_id(path: Column) -> Column:
    """First 16 hex digits of the SHA-1 of a path: one stable name per source file."""
    return F.substring(F.sha1(path), 1, 16)


def last_segment(path: Column) -> Column:
    return F.substring_index(path, "/", -1)
