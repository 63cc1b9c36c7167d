"""List-like strings and lenient dates, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SINGLE = r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"
_DOUBLE = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_QUOTED = rf"{_SINGLE}|{_DOUBLE}"

# A run of text that never enters a quoted item, anchored where the previous match ended.
_BARE_NONE = rf"\G((?:[^'\"N]++|{_QUOTED}|N(?!one\b))*+)None\b"
_BARE_TRUE = rf"\G((?:[^'\"T]++|{_QUOTED}|T(?!rue\b))*+)True\b"
_BARE_FALSE = rf"\G((?:[^'\"F]++|{_QUOTED}|F(?!alse\b))*+)False\b"
_TRAILING_COMMA = r",\s*\]\s*$"
_BRACKETED = r"(?s)^\s*\[.*\]\s*$"

_JSON_OPTIONS = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def list_items(col: Column | str) -> Column:
    """Items of a Python- or JSON-looking list string; null unless the text is such a list."""
    text = _col(col).cast("string")
    plain = text
    for pattern, literal in ((_BARE_NONE, "null"), (_BARE_TRUE, "true"), (_BARE_FALSE, "false")):
        plain = F.regexp_replace(plain, pattern, "$1" + literal)
    plain = F.regexp_replace(plain, _TRAILING_COMMA, "]")
    needs_rewrite = text.rlike(rf"None|True|False|{_TRAILING_COMMA}")
    json = F.when(needs_rewrite, plain).otherwise(text)
    return F.when(text.rlike(_BRACKETED), F.from_json(json, "array<string>", _JSON_OPTIONS))


# Flat lists without escapes are read by regular expressions, which is about ten times cheaper than a JSON parse.
_ITEM = r"""'[^'\\]*+'|"[^"\\]*+"|None|True|False|-?\d++(?:\.\d++)?+"""
_FLAT_LIST = rf"^\s*+\[\s*+(?:(?:{_ITEM})\s*+(?:,\s*+|(?=\])))*+\]\s*+$"
_BLANKS = " \t\n\r\x0b\x0c"


def list_first(col: Column | str) -> Column:
    """First item, stripped; null on null, empty or malformed text."""
    text = _col(col).cast("string")
    item = F.regexp_extract(text, rf"^\s*+\[\s*+({_ITEM})", 1)
    quoted = item.startswith("'") | item.startswith('"')
    flat = F.when(quoted, F.substring(item, F.lit(2), F.length(item) - 2)).when(
        (item != "") & (item != "None"), F.lower(item)
    )
    first = F.when(text.rlike(_FLAT_LIST), flat).when(text.rlike(_BRACKETED), F.get(list_items(text), F.lit(0)))
    return F.btrim(first, F.lit(_BLANKS))


def list_count(col: Column | str) -> Column:
    """Number of items; 0 on null, empty or malformed text."""
    text = _col(col).cast("string")
    count = F.when(text.rlike(_FLAT_LIST), F.regexp_count(text, F.lit(_ITEM))).when(
        text.rlike(_BRACKETED), F.size(list_items(text))
    )
    return F.coalesce(F.when(count >= 0, count), F.lit(0)).cast("int")


def lenient_timestamp(col: Column | str) -> Column:
    """Timestamp, or null where the text is not one; a bare date is its midnight."""
    return _col(col).try_cast("timestamp")


def micros(col: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp, zoned or not."""
    return F.unix_micros(_col(col).cast("timestamp"))


def has_clock_time(col: Column | str) -> Column:
    """Whether a timestamp carries a time of day."""
    ts = _col(col)
    return ts != F.date_trunc("day", ts)
