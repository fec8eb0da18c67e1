"""Pieces of delimited strings: dotted attribute paths and ``category_brand`` codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DOT = r"\."


def segments(path: Column | str) -> Column:
    """All parts of a dotted path, empty ones included."""
    return F.split(path, DOT)


def n_segments(path: Column | str) -> Column:
    """Number of parts of a dotted path, from its length with and without dots: no array is built."""
    path = F.col(path) if isinstance(path, str) else path
    return F.octet_length(path) - F.octet_length(F.replace(path, F.lit("."), F.lit(""))) + 1


def segment(path: Column | str, index: int) -> Column:
    """Part ``index`` of a dotted path, counted from 0; null where the path is shorter."""
    return F.get(segments(path), F.lit(index))


def last_segment(path: Column | str) -> Column:
    """Last part of a dotted path that is not an empty tail (``a.b.`` gives ``b``)."""
    path = F.col(path) if isinstance(path, str) else path
    return F.element_at(segments(F.rtrim(path, F.lit("."))), -1)


def piece(text: Column | str, separator: str, index: int) -> Column:
    """Part ``index`` of ``text`` cut at the regex ``separator``; a negative index counts from the end.

    Empty parts at the end do not count. Null text and an index out of range give null.
    """
    trimmed = F.regexp_replace(text, f"(?:{separator})+$", "")
    at = index + 1 if index >= 0 else index
    return F.try_element_at(F.split(trimmed, separator), F.lit(at))


def category_of(code: Column | str) -> Column:
    """Category of a ``category_brand`` code as int, null where it is no number."""
    return F.get(F.split(code, "_"), F.lit(0)).try_cast("int")


def brand_of(code: Column | str) -> Column:
    """Brand of a ``category_brand`` code as int, null where it is missing or no number."""
    return F.get(F.split(code, "_"), F.lit(1)).try_cast("int")
