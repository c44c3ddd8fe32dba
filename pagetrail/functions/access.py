"""PRS3/PRS4: match the access-line pattern once and cut out its captures.

The pattern has 18 groups. Calling ``regexp_extract`` 18 times would run the
(backtracking) pattern 18 times per line and could not tell "no match" from an
empty capture. Instead one ``regexp_replace`` rewrites a matching line into its
captures joined by ``\\n``:

* the input is prefixed with ``\\n`` and the pattern with ``^\\n``, and the
  replacement starts with U+0001, so a result starting with U+0001 can only
  come from a match (an unmatched line comes back starting with ``\\n``);
* a list of forwarded addresses is matched as one run of its characters, since
  ``java.util.regex`` recurses once per repetition of a group; ``is_ip_list``
  then checks the list's shape, so any number of addresses is read on any stack;
* no capture can hold ``\\n`` (``.`` stops there under ``(?d)``, ``\\d``/``\\w``
  and ``[^\\s]`` exclude it) except ``ip``, whose ``,\\s`` may; ``ip`` is put
  last and the split is limited, so it keeps whatever it holds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ASCII_FLAGS, PY_FLAGS, PY_SPACE, ascii_pattern, is_ascii, java_pattern

_MARK = "\u0001"

# The group of one or more addresses, each with an optional ``,`` and space behind it.
_IP_LIST = r"(?:\d+\.\d+\.\d+\.\d+(?:,\s)?)+"
_IP_LIST_CHARS = r"[\d.,\s]+"
# A possessive repetition is matched in a loop. It takes no list of addresses that stand
# without a separator, so only what it accepts is decided by it.
_PLAIN_BODY = r"^(?:\d+\.\d+\.\d+\.\d+(?:," + PY_SPACE + r")?)++\z"
_PLAIN_LIST, _ASCII_LIST = PY_FLAGS + _PLAIN_BODY, ASCII_FLAGS + ascii_pattern(_PLAIN_BODY)


def is_ip_list(ip: Column) -> Column:
    """Whether the text is one or more ``n.n.n.n``, each optionally followed by a comma and one space.

    Addresses may stand without a separator: of the numbers between dots every
    third inner one then holds the end of one address and the start of the next,
    so it needs two digits.
    """
    pieces = F.split(ip, "," + PY_SPACE, -1)

    def run(piece: Column) -> Column:
        numbers = F.split(piece, "\\.", -1)
        return (
            (F.size(numbers) > 3) & (F.size(numbers) % 3 == 1)
            & F.forall(numbers, lambda n: n.rlike("(?U)^\\d+$"))
            & F.forall(F.transform(numbers, lambda n, i: (i % 3 != 0) | (i == 0) | (i == F.size(numbers) - 1) | (F.length(n) > 1)),
                       lambda ok: ok)
        )

    # a separator may end the list
    listed = F.when((F.size(pieces) > 1) & (F.element_at(pieces, -1) == ""), F.slice(pieces, F.lit(1), F.size(pieces) - 1)).otherwise(pieces)
    return F.when(ip.rlike(_ASCII_LIST), F.lit(True)).when(ip.rlike(_PLAIN_LIST), F.lit(True)).otherwise(F.forall(listed, run))


class AccessPattern:
    """A compiled view of one access-line pattern for Spark."""

    def __init__(self, py_pattern: str, tail_group: str = "ip"):
        self.ip_list = _IP_LIST in py_pattern
        body, names = java_pattern(py_pattern.replace(_IP_LIST, _IP_LIST_CHARS))
        self.names = names
        numbers = {n: i + 1 for i, n in enumerate(names)}
        self.order = [n for n in names if n != tail_group] + [tail_group]
        self.regex = PY_FLAGS + "^\\n" + body + "[\\s\\S]*"
        self.ascii_regex = ASCII_FLAGS + "^\\n" + ascii_pattern(body) + "(?s:.*)"
        self.replacement = _MARK + "\n".join("$%d" % numbers[n] for n in self.order)

    def packed(self, log: Column) -> Column:
        def by(regex: str) -> Column:
            return F.regexp_replace(F.concat(F.lit("\n"), log), F.lit(regex), F.lit(self.replacement))

        # Unicode classes cost several times as much a character and matter only to other text
        return F.when(is_ascii(log), by(self.ascii_regex)).otherwise(by(self.regex))

    @staticmethod
    def matched(packed: Column) -> Column:
        return packed.startswith(_MARK)

    def parts(self, packed: Column) -> Column:
        """Array of captures in ``self.order``; NULL when the line did not match."""
        # a one-character, non-meta separator takes Java's split fast path
        return F.when(packed.startswith(_MARK),
                      F.split(F.substring(packed, 2, 1 << 30), "\n", len(self.order)))

    def field(self, parts: Column, name: str) -> Column:
        return parts.getItem(self.order.index(name))
