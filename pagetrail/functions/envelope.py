"""PRS1: decode the per-line envelope and take its ``log`` value.

A raw line is expected to be one literal dict holding a string ``log`` (what a
container runtime's JSON log driver writes). The source pipeline evaluated it
as a Python literal, so this module has to tell three things apart:

* ``env_ok``     - the line is one literal that is a dict with a ``log`` key;
* ``log_is_str`` - that value is a string (anything else fails the pattern);
* ``log``        - the string value.

A line that Spark's strict JSON reader (variant) accepts is decided by it: the
line is wrapped in ``[...]`` so that trailing junk or a second value fail,
``null``, ``true`` and ``false`` (not Python literals) are found in the inferred
variant schema, and the type of ``log`` is read from the schema of that field.
Only the other lines (Python-only forms such as single quotes, ``None``, tuples,
comments, duplicate keys; and broken lines) go, in Arrow batches, to Python's own
literal parser, so every line follows the literal rule.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# a type token (not a key) in schema_of_variant output, e.g. "OBJECT<a: VOID>"
_NON_LITERAL_TYPE = r"(^|<|: )(VOID|BOOLEAN)(>|,|$)"


# "\/" escapes a slash in JSON; a Python literal keeps both characters. An
# unescaped backslash (odd run) before "/" is doubled so JSON keeps it too.
_SLASH_ESCAPE = r"(?<!\\)((?:\\\\)*+)\\/"


def _python_escapes(line: Column) -> Column:
    return F.when(line.contains("\\/"),
                  F.regexp_replace(line, _SLASH_ESCAPE, "$1\\\\\\\\/")).otherwise(line)


def _strict_envelope(strict: Column, log_variant: Column) -> tuple[Column, Column, Column, Column]:
    """(decided, env_ok, log_is_str, log) of the lines that strict JSON accepts; native.

    A value at "$[0].log" means the first element is an object holding "log".
    """
    single = F.variant_get(strict, "$[1]", "variant").isNull()
    literal = ~F.coalesce(F.schema_of_variant(strict).rlike(_NON_LITERAL_TYPE), F.lit(False))
    strict_ok = log_variant.isNotNull() & single & literal
    strict_is_str = F.schema_of_variant(log_variant) == F.lit("STRING")
    strict_log = F.variant_get(strict, "$[0].log", "string")
    return strict.isNotNull(), strict_ok, F.coalesce(strict_is_str, F.lit(False)), F.when(strict_is_str, strict_log)


def _with_strict(lines: DataFrame, line: Column) -> DataFrame:
    """``lines`` and the strict envelope of each, evaluated once a line.

    The steps are fenced from each other: predicates and Python functions above take the columns as they
    are, while expressions of them would be copied, and the line parsed again, wherever one is named.
    """
    kept = lines.columns
    json = lines.select(*kept, F.try_parse_json(F.concat(F.lit("["), _python_escapes(line), F.lit("]"))).alias("_json"))
    json = json.select(*kept, "_json", F.variant_get("_json", "$[0].log", "variant").alias("_log"))
    decided, env_ok, log_is_str, log = _strict_envelope(F.col("_json"), F.col("_log"))
    return json.select(*kept, decided.alias("_decided"), env_ok.alias("_ok"), log_is_str.alias("_is_str"), log.alias("_text"))


def with_envelope(lines: DataFrame, line_col: str = "line", rule: str = "both") -> DataFrame:
    """Add (env_ok, log_is_str, log) and ``undecided``.

    ``rule="strict"`` is native and marks the lines it can't decide; ``"literal"`` sends every line to
    Python's literal parser (meant for those); ``"both"`` decides all lines in one pass.
    """
    line = F.col(line_col)
    kept, decided = lines.columns, F.col("_decided")
    if rule == "strict":
        return _with_strict(lines, line).select(*kept, F.coalesce("_ok", F.lit(False)).alias("env_ok"), F.col("_is_str").alias("log_is_str"),
                                                F.col("_text").alias("log"), (~decided).alias("undecided"))
    if rule == "literal":
        lines = lines.withColumn("_literal", _literal_envelope()(line))
        env_ok, log_is_str, log = (F.col("_literal").getField(f) for f in ("env_ok", "log_is_str", "log"))
        lines = lines.select("*", F.coalesce(env_ok, F.lit(False)).alias("env_ok"),
                             F.coalesce(log_is_str, F.lit(False)).alias("log_is_str"), log.alias("log")).drop("_literal")
    else:
        lines = _with_strict(lines, line).withColumn("_literal", _literal_envelope()(F.when(~decided, line)))
        either = {f: F.when(decided, F.col(own)).otherwise(F.col("_literal").getField(f))
                  for f, own in (("env_ok", "_ok"), ("log_is_str", "_is_str"), ("log", "_text"))}
        lines = lines.select(*kept, *[F.coalesce(either[f], F.lit(False)).alias(f) for f in ("env_ok", "log_is_str")],
                             either["log"].alias("log"))
    return lines.withColumn("undecided", F.lit(False))


def _literal_envelope():
    """A pandas UDF giving (env_ok, log_is_str, log) of lines under Python's literal rule; null lines are skipped.

    The function is nested so that it travels to the executors by value.
    """

    @F.pandas_udf("env_ok boolean, log_is_str boolean, log string")
    def decode(lines: pd.Series) -> pd.DataFrame:
        import ast
        import warnings

        def one(text):
            if text is None:
                return None, None, None
            try:
                value = ast.literal_eval(text)
            except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
                return False, False, None
            if not isinstance(value, dict) or "log" not in value:
                return False, False, None
            log = value["log"]
            if isinstance(log, str):
                # paired surrogate escapes are one character; a lone one can't be stored as UTF-8
                return True, True, log.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
            # startswith(str) raises TypeError for bytes: counted like a malformed line
            return not isinstance(log, bytes), False, None

        with warnings.catch_warnings():
            warnings.simplefilter("ignore")  # unknown escapes are kept, as they were
            return pd.DataFrame([one(t) for t in lines], columns=["env_ok", "log_is_str", "log"])

    return decode
