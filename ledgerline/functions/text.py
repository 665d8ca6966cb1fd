"""String helpers for file names, call stacks and log rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import constants as K


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path: Column | str) -> Column:
    """Last path component (after the last '/')."""
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


# A name has an extension when a character other than '.' comes before its
# last dot ("a.b.csv" -> ".csv"; ".profile" and "..a" have none), as
# os.path.splitext splits names.
_EXT_SPLIT = r"^(.*[^.].*)(\.[^.]*)$"


def extension(name: Column | str) -> Column:
    """Extension with its dot, or '' if none (of the last path component)."""
    return F.regexp_extract(base_name(name), _EXT_SPLIT, 2)


def stem(name: Column | str) -> Column:
    """Name without its last extension."""
    n = _c(name)
    return F.left(n, F.length(n) - F.length(extension(n)))


def has_accepted_extension(name: Column | str) -> Column:
    """True for names ending in an accepted extension, case-insensitively."""
    lowered = F.lower(_c(name))
    cond = F.lit(False)
    for ext in K.ACCEPTED_EXTENSIONS:
        cond = cond | lowered.endswith(ext)
    return cond


def fits_glob(name: Column | str, pattern: Column | str) -> Column:
    """True if the whole name fits a pattern of ``*`` and ``?``, whatever the case."""
    literal = F.regexp_replace(_c(pattern), r"[^\w*?]", r"\\$0")
    wild = F.replace(F.replace(literal, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit("."))
    return F.regexp_like(_c(name), F.concat(F.lit("(?is)^"), wild, F.lit("\\z")))


def error_file_name(name: Column | str, issue: Column | str) -> Column:
    """``<stem>.InvalidColumnHeader.<Issue><ext>``, or ``<stem>.Empty<ext>``.

    ``issue`` equal to ``Empty`` produces the empty-file name.
    """
    n, i = _c(name), _c(issue)
    return F.when(i == F.lit(K.EMPTY_TAG),
                  F.concat(stem(n), F.lit("." + K.EMPTY_TAG), extension(n))) \
        .otherwise(F.concat(stem(n), F.lit("." + K.INVALID_HEADER_TAG + "."), i, extension(n)))


def call_stack(parent: Column | str, current: Column | str) -> Column:
    """Append a function name to a ``' > '``-joined call stack."""
    return F.concat_ws(K.CALL_STACK_JOINER, _c(parent), _c(current))


def severity(issue: Column | str) -> Column:
    """``Info`` when there is no issue, else ``Error``."""
    i = _c(issue)
    return F.when(i.isNull() | (i == F.lit("")), F.lit(K.SEVERITY_INFO)) \
        .otherwise(F.lit(K.SEVERITY_ERROR))


def error_message(script: Column | str, function: Column | str, line: Column | str,
                  message: Column | str) -> Column:
    """Error text of a log row: ``Error in <script> > <function>() on line <n>: <msg>``."""
    return F.format_string("Error in %s > %s() on line %s: %s",
                           _c(script), _c(function), _c(line), _c(message))


def log_timestamp(ts: Column | str) -> Column:
    """Timestamp as text with microseconds, as the log writes it."""
    return F.date_format(_c(ts), K.LOG_TIMESTAMP_FORMAT)
