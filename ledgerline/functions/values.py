"""Cleansing of text cells: NULL tokens and type coercion.

Everything stays JVM-side: ``try_cast`` / ``try_to_timestamp`` never raise
under ANSI mode, so a bad cell becomes NULL and can be counted and set aside
instead of failing the job.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import constants as K

# Date / timestamp layouts, each with the text shape that selects it.  Only
# the one matching layout is tried, so a bad cell costs a regex match rather
# than a chain of failed parses (failed parses are expensive under ANSI).
DATE_LAYOUTS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
)
TIMESTAMP_LAYOUTS = (
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
)
_ISO_TIMESTAMP = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"
_INTEGER = r"^[+-]?\d+$"
_REAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^(?i)[+-]?(nan|inf|infinity)$"

# Money text: optional sign and currency symbol, digits with optional
# thousands groups and decimals, accounting parentheses or a trailing minus.
# Anything else (letters, European decimal commas) is a bad cell, not a number.
MONEY_SHAPE = (r"^\(?\s*[+-]?\s*[$€£¥]?\s*[+-]?(\d{1,3}(,\d{3})+|\d+)?(\.\d+)?"
               r"\s*-?\s*\)?$")

# Day and month as numbers: the two orders share a shape, so the text alone doesn't tell which it is.
# A family is told by its separator.
FAMILIES = ("/", ".", "-")
MONTH_FIRST, DAY_FIRST = "M", "d"
_MONTH, _DAY, _CLOCK = "(0?[1-9]|1[0-2])", "(0?[1-9]|[12][0-9]|3[01])", r"( \d{1,2}:\d{2}(:\d{2})?)?"
# A datatype with its layout, as in ``date(d/M/yyyy)``.
_WITH_LAYOUT = re.compile(r"(date|timestamp)\(\s*([^)]*[dM][^)]*)\)")

_DECIMAL = re.compile(r"decimal\(\s*(\d+)\s*,\s*(\d+)\s*\)")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens_to_null(col: Column | str, tokens: tuple[str, ...] = K.NULL_TOKENS) -> Column:
    """Cell -> NULL when, trimmed, it is one of the NULL tokens."""
    c = _c(col)
    return F.when(F.trim(c).isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def parse_amount(col: Column | str, scale: int = 2, precision: int = 18) -> Column:
    """Money text -> decimal.  Handles currency symbols, thousands separators,
    a trailing or leading minus and accounting negatives ``(1,234.50)``."""
    c = F.trim(_c(col))
    negative = (c.startswith("(") & c.endswith(")")) | c.endswith("-")
    digits = F.regexp_replace(c, r"[^0-9.\-]", "")
    digits = F.regexp_replace(digits, r"-$", "")
    shaped = c.rlike(MONEY_SHAPE) & c.rlike(r"\d") & digits.rlike(r"^-?(\d+\.?\d*|\.\d+)$")
    value = F.when(shaped, digits.try_cast(f"decimal({min(precision + 10, 38)},{scale + 8})"))
    signed = F.when(negative, -F.abs(value)).otherwise(value).try_cast(f"decimal({precision},{scale})")
    # A plain number needs one look.
    plain = rf"^-?\d{{1,{precision - scale}}}" + (rf"(\.\d{{1,{scale}}})?$" if scale else "$")
    if precision <= scale:
        return signed
    return F.when(c.rlike(plain), c.try_cast(f"decimal({precision},{scale})")).otherwise(signed)


def declared_layout(datatype: str | None) -> tuple[str, str | None]:
    """(type, order of day and month if the datatype names a layout)."""
    t = (datatype or "string").strip()
    m = _WITH_LAYOUT.fullmatch(t)
    if not m:
        return t, None
    day, month = m.group(2).find("d"), m.group(2).find("M")
    if day < 0 or month < 0:
        raise ValueError(f"{datatype!r} names no day or no month")
    return m.group(1), DAY_FIRST if day < month else MONTH_FIRST


def date_family(col: Column | str) -> Column:
    """Separator of a cell whose day and month are numbers before a year; NULL for other cells."""
    c = F.trim(_c(col))
    return F.coalesce(*[F.when(c.rlike(rf"^\d{{1,2}}[{s}]\d{{1,2}}[{s}]\d{{4}}{_CLOCK}$"), F.lit(s)) for s in FAMILIES])


def fits_order(col: Column | str, order: str, family: Column | None = None) -> Column:
    """True if the cell's numbers can be a month and a day in this order.

    ``family``: the cells' ``date_family``, if it is known already.
    """
    one, two = (_MONTH, _DAY) if order == MONTH_FIRST else (_DAY, _MONTH)
    c = F.trim(_c(col))
    if family is not None:
        found = F.lit(False)
        for s in FAMILIES:
            found = F.when(family == s, c.rlike(rf"^{one}[{s}]{two}[{s}]\d{{4}}{_CLOCK}$")).otherwise(found)
        return found
    fits = F.lit(False)
    for s in FAMILIES:
        fits = fits | c.rlike(rf"^{one}[{s}]{two}[{s}]\d{{4}}{_CLOCK}$")
    return fits


def coerce_ordered(col: Column | str, datatype: str, order: str, family: Column | None = None) -> Column:
    """Text cell -> date or timestamp, with day and month in the given order where both are numbers.

    ``family``: the cells' ``date_family``, if it is known already.
    """
    c = F.trim(_c(col))
    out = F.when((date_family(c) if family is None else family).isNull(), coerce(c, datatype))
    one, two = ("M", "d") if order == MONTH_FIRST else ("d", "M")
    for s in FAMILIES:
        for clock, shape in ((" H:mm:ss", r" \d{1,2}:\d{2}:\d{2}$"), (" H:mm", r" \d{1,2}:\d{2}$"), ("", r"\d{4}$")):
            if clock and datatype == "date":
                continue
            if family is None:
                fits = fits_order(c, order) & c.contains(s) & c.rlike(shape)
            else:
                fits = (family == s) & fits_order(c, order, family) & c.rlike(shape)
            out = out.when(fits, F.try_to_timestamp(c, F.lit(f"{one}{s}{two}{s}yyyy{clock}")).cast(datatype))
    return out


def coerce(col: Column | str, datatype: str) -> Column:
    """Text cell -> declared type; NULL when the text does not parse.

    A date without a declared layout is read month first where day and month are parted by
    slashes; ``date(d/M/yyyy)`` reads it day first.
    """
    c = F.trim(_c(col))
    base, order = declared_layout(datatype)
    if order:
        return coerce_ordered(c, base, order)
    t = base.lower()
    m = _DECIMAL.fullmatch(t)
    if m:
        return parse_amount(c, scale=int(m.group(2)), precision=int(m.group(1)))
    if t in ("string", ""):
        return _c(col).cast("string")
    if t in ("int", "integer", "bigint", "long"):
        target = "int" if t in ("int", "integer") else "bigint"
        n = F.regexp_replace(c, ",", "")
        return F.when(n.rlike(_INTEGER), n.try_cast(target))
    if t in ("double", "float"):
        n = F.regexp_replace(c, ",", "")
        return F.when(n.rlike(_REAL), n.try_cast("double"))
    if t == "boolean":
        lowered = F.lower(c)
        return F.when(lowered.isin("true", "t", "yes", "y", "1"), F.lit(True)) \
            .when(lowered.isin("false", "f", "no", "n", "0"), F.lit(False))
    if t == "date":
        out = F.lit(None).cast("date")
        for shape, fmt in reversed(DATE_LAYOUTS):
            out = F.when(c.rlike(shape), F.to_date(F.try_to_timestamp(c, F.lit(fmt)))).otherwise(out)
        return out
    if t == "timestamp":
        out = F.when(c.rlike(_ISO_TIMESTAMP), c.try_cast("timestamp"))
        for shape, fmt in TIMESTAMP_LAYOUTS + DATE_LAYOUTS:
            out = out.when(c.rlike(shape), F.try_to_timestamp(c, F.lit(fmt)))
        return out
    raise ValueError(f"unsupported datatype {datatype!r}; expected one of {K.SUPPORTED_TYPES}")
