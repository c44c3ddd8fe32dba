"""PRS6-PRS12 and the storability checks: typed values from captured text.

Every function here returns a Column built from built-in expressions so the
whole parse stays inside whole-stage codegen.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ASCII_FLAGS, PY_FLAGS, PY_SPACE, ascii_pattern, is_ascii, py_strip

# ---------------------------------------------------------------------------
# digits: Python's int() (and strptime) take any Unicode decimal digit; Spark's
# casts take ASCII only, so digits are mapped to ASCII first. The table is
# derived from the running Python's Unicode database.
# ---------------------------------------------------------------------------
_OTHER_DIGITS = "".join(chr(c) for c in range(0x80, 0x110000) if unicodedata.decimal(chr(c), None) is not None)
_THEIR_VALUES = "".join(str(unicodedata.decimal(ch)) for ch in _OTHER_DIGITS)


def ascii_digits(text: Column) -> Column:
    return F.when(is_ascii(text), text).otherwise(F.translate(text, _OTHER_DIGITS, _THEIR_VALUES))


# ---------------------------------------------------------------------------
# %c timestamps (C locale: "%a %b %d %H:%M:%S %Y", matched case-insensitively,
# whitespace runs allowed, the whole text consumed, weekday not checked)
# ---------------------------------------------------------------------------
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_CTIME = (
    "^\\n(mon|tue|wed|thu|fri|sat|sun)" + PY_SPACE + "+"
    "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)" + PY_SPACE + "+"
    "(3[01]|[12]\\d|0[1-9]|[1-9]| [1-9])" + PY_SPACE + "+"
    "(2[0-3]|[0-1]\\d|\\d):([0-5]\\d|\\d):(6[0-1]|[0-5]\\d|\\d)" + PY_SPACE + "+"
    "(\\d\\d\\d\\d)\\z"
)


def parse_ctime(text: Column) -> Column:
    """``datetime.strptime(text, "%c")`` as TIMESTAMP_NTZ; NULL where Python raises."""
    def by(pattern: str) -> Column:
        return F.regexp_replace(F.concat(F.lit("\n"), text), F.lit("(?i)" + pattern), F.lit("\u0001$2,$3,$4,$5,$6,$7"))

    packed = F.when(is_ascii(text), by(ASCII_FLAGS + ascii_pattern(_CTIME))).otherwise(by(PY_FLAGS + _CTIME))
    parts = F.split(ascii_digits(F.substring(packed, 2, 1 << 30)), ",")
    month = ((F.instr(F.lit(_MONTHS), F.lower(parts.getItem(0))) + 2) / 3).cast("int")
    day = F.trim(parts.getItem(1)).try_cast("int")
    hour = parts.getItem(2).try_cast("int")
    minute = parts.getItem(3).try_cast("int")
    second = parts.getItem(4).try_cast("int")
    year = parts.getItem(5).try_cast("int")
    ts = F.try_make_timestamp_ntz(year, month, day, hour, minute, second)
    # Python's datetime refuses second 60/61 and year 0; Spark rolls or accepts them
    return F.when(packed.startswith("\u0001") & (second < 60) & (year >= 1), ts)


# ---------------------------------------------------------------------------
# integers
# ---------------------------------------------------------------------------
# int() of a stripped string: optional sign, digits, single underscores between
# digits. Written without a repeated group (java.util.regex would recurse once
# per repetition): a digit first and last, digits and '_' between, no "__".
_PY_INT_CHARS = "(?U)^[+-]?\\d([\\d_]*\\d)?$"


def py_int_value(text: Column) -> Column:
    """INT value of a Python int literal; NULL when it does not fit 32 bits."""
    return F.regexp_replace(ascii_digits(py_strip(text)), "_", "").try_cast("int")


def digits_value(text: Column) -> Column:
    """INT value of a ``\\d*`` capture; NULL when empty or out of the INT range."""
    return ascii_digits(text).try_cast("int")


# ---------------------------------------------------------------------------
# cookies: split on ';', then on '=', keep items 0 and 1 stripped (a value is
# cut at a second '='), ignore items without '=', the last duplicate wins
# ---------------------------------------------------------------------------

def cookie_pairs(cookies: Column) -> Column:
    """ARRAY<STRUCT<k,v>> of the cookie items in order."""
    def pairs(strip) -> Column:
        items = F.transform(F.split(cookies, ";", -1), lambda x: F.split(x, "=", -1))
        kept = F.filter(items, lambda a: F.size(a) > 1)
        return F.transform(kept, lambda a: F.struct(strip(a.getItem(0)).alias("k"), strip(a.getItem(1)).alias("v")))

    # where the only white space is the plain space, trimming it is all that stripping does
    plain = is_ascii(cookies) & ~cookies.rlike("[\\t-\\r\\x1C-\\x1F]")
    return F.when(plain, pairs(F.trim)).otherwise(pairs(py_strip))


def cookie_value(pairs: Column, key: str) -> Column:
    """Value of the last item named ``key``; NULL when absent."""
    last_first = F.reverse(pairs)
    return F.get(last_first, (F.array_position(last_first.getField("k"), F.lit(key)) - 1).cast("int")).getField("v")


def is_int_literal(text: Column) -> Column:
    """Would ``int(text)`` accept this already stripped text."""
    return text.rlike(_PY_INT_CHARS) & ~text.contains("__")


def cookie_int_invalid(pairs: Column, key: str) -> Column:
    """True when any item named ``key`` is not an int literal (the whole line is bad)."""
    return F.exists(pairs, lambda p: (p.getField("k") == F.lit(key)) & ~is_int_literal(p.getField("v")))


# ---------------------------------------------------------------------------
# inet and uuid, as PostgreSQL stores them
# ---------------------------------------------------------------------------
_IPV4 = "^[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}$"
_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_CANONICAL_IPV4 = f"^{_OCTET}\\.{_OCTET}\\.{_OCTET}\\.{_OCTET}\\z"


def inet_text(ip: Column) -> Column:
    """Canonical IPv4 text, or NULL when an inet column would refuse it."""
    octets = F.transform(F.split(ip, "\\."), lambda o: o.try_cast("int"))
    valid = ip.rlike(_IPV4) & F.forall(octets, lambda o: o <= 255)
    return F.when(ip.rlike(_CANONICAL_IPV4), ip).when(valid, F.array_join(F.transform(octets, lambda o: o.cast("string")), "."))


_CANONICAL_UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\\z"
_UUID = "^(\\{[0-9a-fA-F]{4}(-?[0-9a-fA-F]{4}){7}\\}|[0-9a-fA-F]{4}(-?[0-9a-fA-F]{4}){7})$"


def uuid_text(value: Column) -> Column:
    """Canonical lower-case 8-4-4-4-12 uuid text, or NULL when a uuid column would refuse it."""
    hexes = F.lower(F.regexp_replace(value, "[{}-]", ""))
    canon = F.concat_ws("-", F.substring(hexes, 1, 8), F.substring(hexes, 9, 4), F.substring(hexes, 13, 4),
                        F.substring(hexes, 17, 4), F.substring(hexes, 21, 12))
    return F.when(value.rlike(_CANONICAL_UUID), value).when(value.rlike(_UUID), canon)


def first_forwarded_ip(ip: Column) -> Column:
    """``ip.strip().split(",")[0]``."""
    return F.split_part(py_strip(ip), F.lit(","), F.lit(1))
