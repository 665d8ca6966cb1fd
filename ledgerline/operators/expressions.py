"""Checking configured SQL expressions before they run.

An expression comes from a configuration file, so it may compute a value from its row and nothing
else.  The parsed (not yet analysed) expression is walked: only the syntax and the functions listed here
pass, and only the named columns may be read.  What is left out on purpose: calls into the JVM or other
languages, anything that gives another value on each call, run or row order (uuid, rand, now, row ids,
input file), aggregates, windows, generators, subqueries, and files or tables.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Functions of one row's values, the same on every call.
FUNCTIONS = frozenset("""
    abs acos asin atan atan2 bround cbrt ceil ceiling cos degrees exp floor greatest hypot least ln log log10 log2 mod
    negative pmod positive pow power radians round sign signum sin sqrt tan try_add try_divide try_multiply try_subtract
    ascii base64 bit_length btrim char char_length character_length chr concat concat_ws contains endswith
    find_in_set format_number format_string initcap instr lcase left length levenshtein locate lower lpad ltrim
    octet_length overlay position regexp_count regexp_extract regexp_instr regexp_like regexp_replace
    regexp_substr repeat replace reverse right rlike rpad rtrim soundex split_part startswith substr substring
    substring_index to_char to_number translate trim try_to_number ucase upper
    crc32 md5 sha sha1 sha2 xxhash64 hash
    add_months date_add date_diff date_format date_sub date_trunc dateadd datediff datepart day dayofmonth dayofweek
    dayofyear extract hour last_day make_date minute month months_between next_day quarter second to_date to_timestamp
    trunc try_to_date try_to_timestamp weekday weekofyear year
    between coalesce if ifnull isnan isnotnull isnull nanvl nullif nullifzero nvl nvl2 zeroifnull
    bigint boolean cast date decimal double float int smallint string timestamp tinyint
    array array_contains element_at named_struct size split struct
""".split())

# Syntax that the parser gives nodes of its own.
SYNTAX = frozenset("""
    Literal UnresolvedAttribute UnresolvedFunction UnresolvedExtractValue Cast CaseWhen If Coalesce
    Add Subtract Multiply Divide IntegralDivide Remainder UnaryMinus UnaryPositive
    And Or Not EqualTo EqualNullSafe LessThan LessThanOrEqual GreaterThan GreaterThanOrEqual
    In IsNull IsNotNull Like LikeAll LikeAny NotLikeAll NotLikeAny RLike ILike Lower
    BitwiseAnd BitwiseOr BitwiseXor BitwiseNot Concat Substring StringTrim StringTrimLeft StringTrimRight StringTrimBoth
    StringLocate Overlay TimestampAdd TimestampDiff
""".split())


def _parts(names) -> list[str]:
    return [names.apply(i) for i in range(names.size())]


def _nodes(node) -> Iterator:
    waiting = [node]
    while waiting:
        n = waiting.pop()
        yield n
        children = n.children()
        waiting += [children.apply(i) for i in range(children.size())]


def refusal(spark: SparkSession, expression: str, columns: list[str]) -> str | None:
    """Why an expression may not run; None if it may.  ``columns``: those it may read."""
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parseExpression(expression)
    except Exception as exc:  # a parse error comes wrapped in several exception types
        return str(exc).strip().splitlines()[0]
    known = {c.lower() for c in columns}
    for node in _nodes(parsed):
        kind = node.getClass().getSimpleName()
        if kind == "UnresolvedFunction":
            name = ".".join(_parts(node.nameParts()))
            if name.lower() not in FUNCTIONS:
                return f"function {name} is not allowed"
            if node.isDistinct() or node.filter().isDefined():
                return f"function {name} is not used on one row's values"
        elif kind == "UnresolvedAttribute":
            name = _parts(node.nameParts())[0]
            if name.lower() not in known:
                return f"column {name} does not resolve"
        elif kind not in SYNTAX:
            return f"{kind} is not allowed"
    return None


def validate_expression(spark: SparkSession, expression: str, schema: T.StructType) -> str | None:
    """Checks a configured expression against the columns of ``schema``; helper columns (``_...``) don't count.

    Returns None when it may run and resolves, else the reason.
    """
    reason = refusal(spark, expression, [f.name for f in schema.fields if not f.name.startswith("_")])
    if reason:
        return reason
    try:
        spark.createDataFrame([], schema).select(F.expr(expression)).schema
        return None
    except Exception as exc:  # analysis errors surface as several exception types
        return str(exc).splitlines()[0]
