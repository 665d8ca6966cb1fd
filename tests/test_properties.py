"""Property tests: Spark column logic against plain-Python definitions."""

import os

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import coerce, extension, stem
from ledgerline.operators.header import header_check

NAMES = st.sampled_from(["Date", "Amount", "Description", "Extra", "date", ""])
SETTINGS = settings(max_examples=25, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def expected_issue(actual, expected):
    exp = [e for e in expected if e is not None]
    extra = [a for a in actual if a not in exp] or len(actual) != len(set(actual))
    missing = [e for e in exp if e not in actual]
    return ".".join(x for x, bad in (("ExtraColumns", extra), ("MissingColumns", missing)) if bad)


@SETTINGS
@given(st.lists(st.tuples(st.lists(NAMES, max_size=5), st.lists(NAMES, min_size=1, max_size=4)),
                min_size=1, max_size=8))
def test_header_check_matches_definition(spark, cases):
    df = spark.createDataFrame([(i, a, e) for i, (a, e) in enumerate(cases)],
                               "id int, actual array<string>, expected array<string>")
    got = {r["id"]: r["Issue"] for r in header_check(df, "actual", "expected").collect()}
    assert got == {i: expected_issue(a, e) for i, (a, e) in enumerate(cases)}


FILE_NAMES = st.text(alphabet="ab.c_-", min_size=0, max_size=10)


@SETTINGS
@given(st.lists(FILE_NAMES, min_size=1, max_size=10))
@example(["..a", ".profile", "a.", "a.b.c", "", ".", "..", "_.b"])
def test_extension_and_stem_match_definition(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    rows = df.select("n", extension("n").alias("e"), stem("n").alias("s")).collect()
    for r in rows:
        root, ext = os.path.splitext(r["n"])
        assert (r["e"], r["s"]) == (ext, root), r["n"]


@SETTINGS
@given(st.lists(st.one_of(st.integers(-10**9, 10**9).map(str),
                          st.text(alphabet="0123456789-+,. x", max_size=8)),
                min_size=1, max_size=10))
def test_int_coercion_matches_definition(spark, texts):
    def py_int(t):
        s = t.strip().replace(",", "")
        body = s[1:] if s[:1] in "+-" else s
        if not body.isdigit():
            return None
        v = int(s)
        return v if -2**31 <= v < 2**31 else None

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["v"] for r in df.select(coerce("t", "int").alias("v")).collect()]
    assert got == [py_int(t) for t in texts]


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789,.$()-+ a", min_size=0, max_size=10),
                min_size=1, max_size=12))
@example(["$1,234.50", "(3.00)", "5.00-", "1,2", "n/a-12", "-$0.5", "12,345,678.901", ".5", "-"])
def test_money_matches_definition(spark, texts):
    import re
    from decimal import ROUND_HALF_UP, Decimal

    from ledgerline.functions.values import MONEY_SHAPE

    def py_amount(t):
        c = t.strip(" ")
        if not re.match(MONEY_SHAPE, c) or not re.search(r"\d", c):
            return None
        digits = re.sub(r"-$", "", re.sub(r"[^0-9.\-]", "", c))
        if not re.fullmatch(r"-?(\d+\.?\d*|\.\d+)", digits):
            return None
        v = Decimal(digits)
        if (c.startswith("(") and c.endswith(")")) or c.endswith("-"):
            v = -abs(v)
        v = v.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        return v if abs(v) < Decimal(10) ** 16 else None

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["v"] for r in df.select(coerce("t", "decimal(18,2)").alias("v")).collect()]
    assert got == [py_amount(t) for t in texts]
