"""String helpers that give Python's text semantics with JVM-side expressions.

Spark evaluates regular expressions with ``java.util.regex``. Python's ``re``
and ``str`` methods differ in a few places that matter for log parsing:

* ``.`` stops only at ``\\n`` in Python; Java also stops at ``\\r``, U+0085,
  U+2028 and U+2029 unless UNIX_LINES (``(?d)``) is on.
* ``\\d``, ``\\w`` and ``\\s`` are Unicode-aware in Python; Java needs
  UNICODE_CHARACTER_CLASS (``(?U)``).
* Python's whitespace also holds U+001C..U+001F, Java's does not, so ``\\s``
  is widened explicitly.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.isspace() sees it, for use inside Java patterns
# compiled with (?U).
PY_SPACE = r"[\s\x1C-\x1F]"
PY_NOT_SPACE = r"[^\s\x1C-\x1F]"

# Flags that make java.util.regex read a pattern the way Python's re does.
PY_FLAGS = "(?dU)"

# The same within ASCII text, for patterns without (?U): single characters, which Java looks up in a bitmap.
_ASCII_SPACES = r" \t\n\x0B\f\r\x1C\x1D\x1E\x1F"
ASCII_FLAGS = "(?d)"

# Every character str.isspace() accepts, derived from the running Python.
PY_WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())

_NAMED_GROUP = re.compile(r"\(\?P<([A-Za-z_][A-Za-z0-9_]*)>")


def java_pattern(py_pattern: str) -> tuple[str, list[str]]:
    """Translate a Python ``re`` pattern to java.util.regex syntax.

    Returns the Java pattern body (without flags) and the group names in
    group-number order. Only the constructs used by the access patterns are
    handled; anything else is rejected rather than silently mistranslated.
    """
    names = _NAMED_GROUP.findall(py_pattern)
    body = _NAMED_GROUP.sub("(", py_pattern)
    if "(?P" in body or "\\\\" in body:
        raise ValueError("unsupported construct in pattern")
    body = body.replace(r"[^\s]", PY_NOT_SPACE)
    body = body.replace(r"\s", PY_SPACE)
    # after the replacement the only remaining ``\s`` sit inside PY_SPACE /
    # PY_NOT_SPACE; a leftover bare class would mean an unhandled construct
    leftover = body.replace(PY_SPACE, "").replace(PY_NOT_SPACE, "")
    if r"\s" in leftover:
        raise ValueError("unsupported whitespace construct in pattern")
    return body, names


def ascii_pattern(java_body: str) -> str:
    """A pattern body for :data:`PY_FLAGS` as one for :data:`ASCII_FLAGS`: equal on text of ASCII characters only."""
    body = java_body.replace(r"[\d.," + PY_SPACE + "]", f"[0123456789.,{_ASCII_SPACES}]")
    return body.replace(PY_NOT_SPACE, f"[^{_ASCII_SPACES}]").replace(PY_SPACE, f"[{_ASCII_SPACES}]")


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def py_strip(col: Column) -> Column:
    """``str.strip()`` with no argument: remove Unicode whitespace at both ends (no regex)."""
    # text with a printable ASCII character other than a space at both ends stays as it is
    clean = F.substring(col, 1, 1).between("!", "~") & F.substring(col, -1, 1).between("!", "~")
    return F.when(clean, col).otherwise(F.trim(col, F.lit(PY_WHITESPACE)))


def has_nul(col: Column) -> Column:
    """True when the text holds U+0000, which a PostgreSQL text column refuses."""
    return col.contains("\u0000")  # a byte search; ``instr`` compares at every character
