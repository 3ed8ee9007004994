"""Column expressions for names, partial dates, keys and literal splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace of the name cleaner's patterns, spelled out: Java's \s also takes a vertical tab.
_SPACE = r"[\t\n\f\r ]"
# What the name cleaner recognises.
QUALIFIERS = rf"\({_SPACE}*(RABBIT|HORSE|EQUINE|I[- ]?131|LU[- ]?177|TC[- ]?99M){_SPACE}*\)"
FORM_WORDS = rf"{_SPACE}+(TABLETS?|CAPSULES?|CAPLETS?|SOLUTION FOR INJECTION|INJECTION)$"
STRENGTH = rf"{_SPACE}+[0-9][0-9./]*{_SPACE}*(MG|MCG|G|ML|%)$"
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def clean_name(name: Column) -> Column:
    """A product name without parentheses, trailing signs, one form word and one strength with a unit."""
    unwrapped = F.regexp_replace(name, QUALIFIERS, " $1")
    closed = F.regexp_replace(unwrapped, rf"{_SPACE}*\([^)]*\)", "")
    opened = F.regexp_replace(closed, rf"{_SPACE}*\([^)]*$", "")
    signs = F.regexp_replace(F.trim(F.regexp_replace(opened, r"[.,;:\t\n\f\r ]+$", "")), rf"{_SPACE}+", " ")
    return F.nullif(F.regexp_replace(F.regexp_replace(signs, FORM_WORDS, ""), STRENGTH, ""), F.lit(""))


def partial_date(digits: Column) -> Column:
    """A date from 8, 6 or 4 digits; a missing day or month is the first; anything else is null."""
    filled = (
        F.when(F.length(digits) == 8, digits)
        .when(F.length(digits) == 6, F.concat(digits, F.lit("01")))
        .when(F.length(digits) == 4, F.concat(digits, F.lit("0101")))
    )
    return F.to_date(F.try_to_timestamp(filled, F.lit("yyyyMMdd")))


def surrogate_key(*parts: Column) -> Column:
    """md5 of the parts joined by a dash, nulls as a fixed token."""
    return F.md5(F.concat_ws("-", *(F.coalesce(p.cast("string"), F.lit(NULL_KEY)) for p in parts)))


def alternatives(text: Column) -> Column:
    """The options of a string such as ``A OR B`` or ``A AND OR B``, trimmed and upper-cased."""
    return F.transform(F.split(F.replace(text, F.lit(" AND OR "), F.lit(" OR ")), " OR "), lambda x: F.upper(F.trim(x)))


def pieces(text: Column) -> Column:
    """Every ingredient piece of every option, repeats kept, empty pieces kept."""
    return F.flatten(F.transform(alternatives(text), lambda x: F.transform(F.split(x, r"\\"), lambda y: F.upper(F.trim(y)))))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as doubles; null for an empty whole, where ANSI division would raise."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double"))
