"""Cleaning and parsing functions for captured values (F11-F22, O5), all native expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# --- fixed values: markers and formats of the captured pages ---
RATING_SUFFIX = " star"
# Python strftime pattern -> Spark datetime pattern for the two formats in use
DATE_FORMATS = {"%d-%m-%Y": "dd-MM-yyyy", "%Y-%m-%d": "yyyy-MM-dd"}
# text that a number is read from
WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"
NUMBER = r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|nan|inf|infinity)\s*$"
INTEGER_TYPES = ("tinyint", "smallint", "int", "long", "bigint")
# --- end of fixed values ---


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_cast(x: ColumnOrName, to: str = "double") -> Column:
    """Parse text as a number; the missing mark '--', unparsable text and NULL give 0.

    Integer types reject fractional text such as '12.5' (-> 0).  Surrounding
    whitespace is ignored; 'nan' parses to NaN (cleared later by ``nan_to_zero``).
    The text is checked first, since a cast alone also takes suffixes such as '12d'.
    """
    x = _c(x).cast("string")
    parsed = F.when(x.rlike(WHOLE_NUMBER if to in INTEGER_TYPES else NUMBER), F.trim(x).try_cast(to))
    return F.coalesce(parsed, F.lit(0).cast(to))


def out_of_range(x: ColumnOrName, to: str) -> Column:
    """True for whole-number text that type ``to`` cannot hold (such a value must not pass as 0)."""
    x = F.regexp_replace(_c(x).cast("string"), ",", "")
    return F.coalesce(x.rlike(WHOLE_NUMBER) & F.trim(x).try_cast(to).isNull(), F.lit(False))


def clean_number(x: ColumnOrName, to: str = "double") -> Column:
    """Drop thousands separators, then ``safe_cast``."""
    return safe_cast(F.regexp_replace(_c(x).cast("string"), ",", ""), to)


def parse_rating(alt: ColumnOrName) -> Column:
    """'4 star' -> 4; missing or unparsable -> 0."""
    return safe_cast(F.replace(_c(alt), F.lit(RATING_SUFFIX), F.lit("")), "int")


def url_segment(url: ColumnOrName, i: int) -> Column:
    """The i-th element (0-based) of the link split on '/'; NULL when the link is shorter."""
    return F.get(F.split(_c(url), "/"), i)


def absolute_url(base_url: ColumnOrName, path: ColumnOrName) -> Column:
    """scheme://authority of ``base_url`` followed by ``path``."""
    b = _c(base_url)
    return F.concat(F.parse_url(b, F.lit("PROTOCOL")), F.lit("://"), F.parse_url(b, F.lit("AUTHORITY")), _c(path))


def default_missing(x: ColumnOrName, default) -> Column:
    """NULL -> default (F16); ``default`` may be a scalar, '' or an empty list/map."""
    x = _c(x)
    if isinstance(default, list):
        return F.coalesce(x, F.array().cast(T.ArrayType(T.StringType())))
    if isinstance(default, dict):
        return F.coalesce(x, F.create_map().cast(T.MapType(T.StringType(), T.DoubleType())))
    return F.coalesce(x, F.lit(default))


def normalize_name(x: ColumnOrName) -> Column:
    """Runs of non-alphanumerics -> one space, then trim."""
    return F.trim(F.regexp_replace(_c(x), "[^0-9a-zA-Z]+", " "))


def normalize_label(x: ColumnOrName) -> Column:
    """'+' -> 'plus', '/' -> 'and', ' ' -> '_', lower case (F18): 'A1+' -> 'a1plus'."""
    x = F.replace(_c(x), F.lit("+"), F.lit("plus"))
    x = F.replace(x, F.lit("/"), F.lit("and"))
    x = F.replace(x, F.lit(" "), F.lit("_"))
    return F.lower(x)


def to_json_text(x: ColumnOrName) -> Column:
    """An array (or struct) as JSON text."""
    return F.to_json(_c(x))


def strip_text(x: ColumnOrName) -> Column:
    """Trim whitespace including non-breaking spaces at both ends."""
    x = _c(x)
    # before a last line separator that is no such whitespace, as "$" has it, only the expression trims
    odd = reduce(or_, [F.endswith(x, F.lit(c)) for c in "\u0085\u2028\u2029"])
    return F.when(odd, F.regexp_replace(x, "^[\\s\\u00a0]+|[\\s\\u00a0]+$", "")).otherwise(F.btrim(x, F.lit(" \t\n\u000b\f\r\u00a0")))


def compact_array(arr: ColumnOrName) -> Column:
    """Trim every element and drop the empty ones, keeping order."""
    return F.filter(F.transform(_c(arr), lambda e: strip_text(e)), lambda e: e != F.lit(""))


def format_date(d: ColumnOrName, python_pattern: str = "%Y-%m-%d") -> Column:
    """Format a date with one of the job's strftime patterns."""
    return F.date_format(_c(d), DATE_FORMATS.get(python_pattern, python_pattern))


def array_get_default(arr: ColumnOrName, i: int, default: str = "0") -> Column:
    """Element i (0-based) or ``default`` when the array is shorter."""
    return F.coalesce(F.get(_c(arr), i), F.lit(default))


def array_head(arr: ColumnOrName, n: int) -> Column:
    """The first n elements."""
    return F.slice(_c(arr), 1, n)
