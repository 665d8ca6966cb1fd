"""The library's operators applied to the supplied tables.

Each entry pairs a Spark builder ``(spark, sf_dir) -> DataFrame`` with SQL
(DuckDB dialect) that computes the same result directly, so the two can be
compared.  Every entry reads whole tables; none filters rows to stay cheap.
Column names and types are aligned on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import constants as K
from ledgerline.functions import (
    base_name, error_file_name, extension, has_accepted_extension, log_timestamp, severity,
    stable_guid, stem,
)
from ledgerline.operators.cleanse import (
    ColumnRule, align, apply_null_tokens, apply_rules, coerce_columns, rename_first_target_wins,
)
from ledgerline.operators.configuration import for_source, missing_from, with_columns_config
from ledgerline.operators.dedupe import dedupe_rows, distinct_values, keep_first
from ledgerline.operators.dimension import new_members, shape_members
from ledgerline.operators.header import header_check_sets, item_sets
from ledgerline.operators.hierarchy import closure, sums_along
from ledgerline.operators.lookup import account_lookup, lookup
from ledgerline.operators.mapping import (
    new_bridge_rows, processable_rows, resolve_to_map, unprocessable_rows,
)
from ledgerline.plans.calltree import call_tree
from ledgerline.plans.gold import date_dimension_for, date_key, spend_by_category_month
from ledgerline.plans.sqlguid import sql_guid as g
from ledgerline.functions.values import DAY_FIRST, MONEY_SHAPE, MONTH_FIRST, coerce, coerce_ordered
from ledgerline.operators.layouts import chosen_order, layout_counts, layout_name
from ledgerline.session import Tables

Builder = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        CATALOG[name] = (fn, sql)
        return fn
    return deco


def _ts_text_sql(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"


# --- header check (ops 10, 11, 12, 35) ---------------------------------------
# A conversation's roles play the part of a file's header: the configured
# header is the expected list; a role seen twice counts as an extra column.
EXPECTED_ROLES = ["user", "assistant"]


@register("header_issue", f"""
WITH per AS (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY conv_id, role),
agg AS (SELECT conv_id, list(role) AS roles, sum(n) AS n_fields, max(n) > 1 AS has_duplicates
        FROM per GROUP BY conv_id),
chk AS (SELECT conv_id, n_fields, has_duplicates,
          list_sort(list_filter(roles, lambda r: NOT list_contains({EXPECTED_ROLES}, r))) AS extra,
          list_sort(list_filter({EXPECTED_ROLES}, lambda r: NOT list_contains(roles, r))) AS missing
        FROM agg)
SELECT conv_id, CAST(n_fields AS BIGINT) AS n_fields,
       array_to_string(extra, ',') AS extra_columns,
       array_to_string(missing, ',') AS missing_columns,
       has_duplicates,
       concat_ws('.', CASE WHEN len(extra) > 0 OR has_duplicates THEN 'ExtraColumns' END,
                      CASE WHEN len(missing) > 0 THEN 'MissingColumns' END) AS issue
FROM chk
""")
def header_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = Tables(spark, sf_dir).conversations
    sets = item_sets(conv.select("conv_id", "role"), "conv_id", "role")
    checked = header_check_sets(sets, EXPECTED_ROLES)
    return checked.select(
        "conv_id", F.col("n_items").cast("bigint").alias("n_fields"),
        F.array_join("extra_columns", ",").alias("extra_columns"),
        F.array_join("missing_columns", ",").alias("missing_columns"),
        "has_duplicates", F.col("Issue").alias("issue"))


# --- de-duplication (ops 36, 37, 38, 39) --------------------------------------
@register("dedupe_rows", "SELECT DISTINCT user_id, event_type FROM events")
def q_dedupe_rows(spark, sf_dir):
    return dedupe_rows(Tables(spark, sf_dir).events.select("user_id", "event_type"))


@register("dedupe_keep_first", f"""
SELECT user_id, event_type, event_id, {_ts_text_sql('ts')} AS ts_text, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
      FROM events) WHERE rn = 1
""")
def q_dedupe_keep_first(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    first = keep_first(ev, ["user_id", "event_type"], ["ts", "event_id"], ["value"])
    return first.select("user_id", "event_type", "event_id",
                        log_timestamp("ts").alias("ts_text"), "value")


@register("distinct_sources", """
SELECT DISTINCT source FROM (
  SELECT CASE WHEN source = 'src0' THEN NULL ELSE source END AS source FROM documents)
WHERE source IS NOT NULL
""")
def q_distinct_sources(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents
    cleaned = docs.select(F.when(F.col("source") == "src0", F.lit(None))
                          .otherwise(F.col("source")).alias("source"))
    return distinct_values(cleaned, "source")


# --- configuration filters (ops 14, 15, 16, 17) -------------------------------
@register("config_filter_join", """
SELECT c_custkey, o_orderkey, o_orderpriority
FROM customer JOIN orders ON o_custkey = c_custkey
WHERE c_mktsegment = 'BUILDING'
""")
def q_config_filter_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # customers play file-level configuration rows, orders their column rows
    cfg = t.customer.select(F.col("c_custkey").alias("ConfigurationFileID"),
                            F.col("c_mktsegment").alias("Source"))
    cols = t.orders.select(F.col("o_custkey").alias("ConfigurationFileID"), "o_orderkey",
                           "o_orderpriority")
    joined = with_columns_config(for_source(cfg, "BUILDING"), cols)
    return joined.select(F.col("ConfigurationFileID").alias("c_custkey"), "o_orderkey",
                         "o_orderpriority")


@register("missing_config", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o
                  WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')
""")
def q_missing_config(spark, sf_dir):
    t = Tables(spark, sf_dir)
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT") \
        .select(F.col("o_custkey").alias("c_custkey"))
    return missing_from(t.customer.select("c_custkey", "c_name"), urgent, ["c_custkey"])


@register("first_row_scalar", """
SELECT s_nationkey, s_suppkey, s_name FROM (
  SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn FROM supplier)
WHERE rn = 1
""")
def q_first_row_scalar(spark, sf_dir):
    sup = Tables(spark, sf_dir).supplier
    return keep_first(sup, ["s_nationkey"], ["s_suppkey"], ["s_name"])


# --- cleansing (ops 1, 13, 21, 22, 24, 25) -----------------------------------
EXTRA_NULL_TOKENS = ("error",)
_TOKENS_SQL = ", ".join("'" + t.replace("'", "''") + "'" for t in K.NULL_TOKENS + EXTRA_NULL_TOKENS)


@register("null_tokens", f"""
SELECT CASE WHEN trim(event_type) IN ({_TOKENS_SQL}) THEN NULL ELSE event_type END AS event_type,
       count(*) AS n
FROM events GROUP BY 1
""")
def q_null_tokens(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("event_type")
    cleaned = apply_null_tokens(ev, ["event_type"], K.NULL_TOKENS + EXTRA_NULL_TOKENS)
    return cleaned.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register("coerce_types", r"""
SELECT event_id,
       TRY_CAST(replace(trim(regexp_extract(props, ':\s*([^}]*)', 1)), ',', '') AS INTEGER) AS k,
       TRY_CAST(replace(trim(CAST(value AS VARCHAR)), ',', '') AS DOUBLE) AS value,
       TRY_CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS day,
       TRY_CAST(replace(trim(event_type), ',', '') AS INTEGER) AS type_code,
       CAST((CASE WHEN TRY_CAST(replace(trim(event_type), ',', '') AS INTEGER) IS NULL
                  THEN 1 ELSE 0 END) AS INTEGER) AS n_bad
FROM events
""")
def q_coerce_types(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    text = ev.select(
        "event_id",
        F.regexp_extract("props", r":\s*([^}]*)", 1).alias("k"),
        F.col("value").cast("string").alias("value"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.col("event_type").alias("type_code"))
    typed = coerce_columns(text, {"k": "int", "value": "double", "day": "date", "type_code": "int"})
    return typed.select("event_id", "k", "value", "day", "type_code",
                        F.size("_bad_columns").alias("n_bad"))


@register("transform_direct_expression", """
SELECT l_orderkey AS OrderKey, l_linenumber AS LineNumber,
       l_extendedprice * (1 - l_discount) AS Revenue
FROM lineitem
""")
def q_transform_direct_expression(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    rules = [
        ColumnRule("l_orderkey", "OrderKey", K.TRANSFORM_DIRECT, order=1),
        ColumnRule("l_linenumber", "LineNumber", K.TRANSFORM_DIRECT, order=2),
        ColumnRule(None, "Revenue", K.TRANSFORM_EXPRESSION, "l_extendedprice * (1 - l_discount)", order=3),
        # a second rule for the same target is ignored: the first one wins
        ColumnRule("l_extendedprice", "Revenue", K.TRANSFORM_DIRECT, order=4),
    ]
    return apply_rules(li, rules)


RENAME_PAIRS = [("p_partkey", "PartKey"), ("p_name", "Name"), ("p_brand", "Brand"),
                ("p_type", "Category"), ("p_retailprice", "Price"), ("p_size", "Price")]
RENAME_TARGET = T.StructType([
    T.StructField("PartKey", T.LongType()), T.StructField("Name", T.StringType()),
    T.StructField("Brand", T.StringType()), T.StructField("Category", T.StringType()),
    T.StructField("Price", T.DoubleType()), T.StructField("Abbreviation", T.StringType()),
])


@register("rename_align", """
SELECT p_partkey AS PartKey, p_name AS Name, p_brand AS Brand, p_type AS Category,
       p_retailprice AS Price, CAST(NULL AS VARCHAR) AS Abbreviation
FROM part
""")
def q_rename_align(spark, sf_dir):
    part = Tables(spark, sf_dir).part
    return align(rename_first_target_wins(part, RENAME_PAIRS), RENAME_TARGET)


# --- lookups (ops 27, 28) -----------------------------------------------------
_ACCOUNT_NAME_SQL = "'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')"


@register("account_lookup", f"""
SELECT o_orderkey, {_ACCOUNT_NAME_SQL} AS Account,
       CASE WHEN c_name IS NULL THEN NULL ELSE {g('Account', 'c_name')} END AS AccountGUID
FROM orders LEFT JOIN customer ON c_name = {_ACCOUNT_NAME_SQL}
""")
def q_account_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    accounts = shape_members(t.customer.select(F.col("c_name").alias("Name")).distinct(), "Account")
    rows = t.orders.select("o_orderkey", F.concat(
        F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("Account"))
    return account_lookup(rows, accounts).select("o_orderkey", "Account", "AccountGUID")


@register("dimension_lookup", f"""
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN p.p_partkey IS NULL THEN NULL ELSE {g('Part', 'p.p_partkey')} END AS PartGUID,
       p.p_brand AS Brand
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 20) p ON p.p_partkey = l_partkey
""")
def q_dimension_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    dim = t.part.where(F.col("p_size") < 20).select(
        F.col("p_partkey").cast("string").alias("Name"),
        stable_guid("Part", "p_partkey").alias("PartGUID"), F.col("p_brand").alias("Brand"))
    src = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                            F.col("l_partkey").cast("string").alias("SourceValue"))
    return lookup(src, dim, "SourceValue", "Name", ["PartGUID", "Brand"]).drop("SourceValue")


# --- mapping bridge (ops 29, 30, 31, 32, 33) ----------------------------------
def _bridge_dims(t: Tables) -> dict[str, DataFrame]:
    part, sup = t.part, t.supplier
    names = {
        "Brand": part.where(~F.col("p_brand").like("Brand#1%")).select(F.col("p_brand").alias("Name")),
        "Category": part.where(F.col("p_type") != "PROMO").select(F.col("p_type").alias("Name")),
        "ProductService": part.select(F.col("p_name").alias("Name")),
        "Seller": sup.where(F.col("s_acctbal") >= 0).select(F.col("s_name").alias("Name")),
    }
    return {d: shape_members(n.distinct(), d) for d, n in names.items()}


def _to_map(t: Tables, lines: DataFrame) -> DataFrame:
    pairs = dedupe_rows(lines.select("l_partkey", "l_suppkey"))
    return (pairs.join(t.part, pairs["l_partkey"] == t.part["p_partkey"], "inner")
            .join(t.supplier, pairs["l_suppkey"] == t.supplier["s_suppkey"], "inner")
            .select("l_partkey", "l_suppkey", F.col("p_brand").alias("Brand"),
                    F.col("p_type").alias("Category"), F.col("p_name").alias("ProductService"),
                    F.col("s_name").alias("Seller")))


def _resolution_sql(where: str = "") -> str:
    return f"""
tm AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem {where}),
t AS (SELECT tm.l_partkey, tm.l_suppkey, p_brand AS Brand, p_type AS Category,
             p_name AS ProductService, s_name AS Seller
      FROM tm JOIN part ON p_partkey = tm.l_partkey JOIN supplier ON s_suppkey = tm.l_suppkey),
b AS (SELECT DISTINCT p_brand AS Name FROM part WHERE p_brand NOT LIKE 'Brand#1%'),
c AS (SELECT DISTINCT p_type AS Name FROM part WHERE p_type <> 'PROMO'),
ps AS (SELECT DISTINCT p_name AS Name FROM part),
s AS (SELECT DISTINCT s_name AS Name FROM supplier WHERE s_acctbal >= 0),
r AS (SELECT t.l_partkey, t.l_suppkey,
        CASE WHEN b.Name IS NULL THEN NULL ELSE {g('Brand', 'b.Name')} END AS BrandGUID,
        CASE WHEN c.Name IS NULL THEN NULL ELSE {g('Category', 'c.Name')} END AS CategoryGUID,
        CASE WHEN ps.Name IS NULL THEN NULL ELSE {g('ProductService', 'ps.Name')} END
          AS ProductServiceGUID,
        CASE WHEN s.Name IS NULL THEN NULL ELSE {g('Seller', 's.Name')} END AS SellerGUID,
        (b.Name IS NOT NULL AND c.Name IS NOT NULL AND ps.Name IS NOT NULL AND s.Name IS NOT NULL)
          AS resolved
      FROM t LEFT JOIN b ON t.Brand = b.Name LEFT JOIN c ON t.Category = c.Name
             LEFT JOIN ps ON t.ProductService = ps.Name LEFT JOIN s ON t.Seller = s.Name)"""


@register("map_resolve", f"""
WITH {_resolution_sql()}
SELECT l_partkey, l_suppkey, BrandGUID, CategoryGUID, ProductServiceGUID, SellerGUID, resolved
FROM r
""")
def q_map_resolve(spark, sf_dir):
    t = Tables(spark, sf_dir)
    resolved = resolve_to_map(_to_map(t, t.lineitem), _bridge_dims(t))
    return resolved.select("l_partkey", "l_suppkey", "BrandGUID", "CategoryGUID",
                           "ProductServiceGUID", "SellerGUID", "resolved")


_BRIDGE_KEY = ["BrandGUID", "CategoryGUID", "SellerGUID"]


@register("bridge_new_rows", f"""
WITH {_resolution_sql("")},
cand AS (SELECT DISTINCT BrandGUID, CategoryGUID, SellerGUID FROM r),
br AS (SELECT DISTINCT BrandGUID, CategoryGUID, SellerGUID FROM (
  WITH {_resolution_sql("WHERE l_returnflag = 'A'")} SELECT * FROM r))
SELECT BrandGUID, CategoryGUID, SellerGUID FROM cand
WHERE NOT EXISTS (SELECT 1 FROM br WHERE br.BrandGUID IS NOT DISTINCT FROM cand.BrandGUID
                    AND br.CategoryGUID IS NOT DISTINCT FROM cand.CategoryGUID
                    AND br.SellerGUID IS NOT DISTINCT FROM cand.SellerGUID)
""")
def q_bridge_new_rows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    dims = _bridge_dims(t)
    li = t.lineitem
    cand = resolve_to_map(_to_map(t, li), dims)
    bridge = resolve_to_map(_to_map(t, li.where(F.col("l_returnflag") == "A")), dims)
    return new_bridge_rows(cand, bridge.select(*_BRIDGE_KEY), _BRIDGE_KEY)


def _pending_orders(t: Tables) -> DataFrame:
    li, part = t.lineitem, t.part
    small = part.where(F.col("p_size") < 3).select("p_partkey")
    return li.join(small, li["l_partkey"] == small["p_partkey"], "left_semi").select("l_orderkey")


_PENDING_SQL = ("SELECT l.l_orderkey FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey "
                "WHERE p.p_size < 3")


@register("unprocessable_rows", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_orderkey IN ({_PENDING_SQL})
""")
def q_unprocessable_rows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return unprocessable_rows(rows, _pending_orders(t), key="l_orderkey")


@register("processable_rows", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_orderkey NOT IN ({_PENDING_SQL})
""")
def q_processable_rows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return processable_rows(rows, _pending_orders(t), key="l_orderkey")


# --- dimensions (op 34) -------------------------------------------------------
@register("dimension_new_members", f"""
SELECT DISTINCT p_brand AS Name, {g('Brand', 'p_brand')} AS BrandGUID FROM part
WHERE p_brand IS NOT NULL AND trim(p_brand) <> ''
  AND p_brand NOT IN (SELECT p_brand FROM part WHERE p_brand LIKE 'Brand#1%')
""")
def q_dimension_new_members(spark, sf_dir):
    part = Tables(spark, sf_dir).part
    seed = shape_members(part.where(F.col("p_brand").like("Brand#1%"))
                         .select(F.col("p_brand").alias("Name")).distinct(), "Brand")
    return new_members(part, "p_brand", seed, "Brand").select("Name", "BrandGUID")


# A natural key of two columns; pairs that the dimension holds are left out, others of
# the same Name are new members.
@register("dimension_composite_key", f"""
SELECT DISTINCT p_type AS Name, p_brand AS Abbreviation,
       {g('UnitOfMeasurement', 'p_type || chr(31) || p_brand')} AS UnitOfMeasurementGUID FROM part
WHERE p_type IS NOT NULL AND trim(p_type) <> '' AND p_brand NOT LIKE 'Brand#1%'
""")
def q_dimension_composite_key(spark, sf_dir):
    part = Tables(spark, sf_dir).part
    key = ["Name", "Abbreviation"]
    named = part.select(F.col("p_type").alias("Name"), F.col("p_brand").alias("Abbreviation"))
    seed = shape_members(named.where(F.col("Abbreviation").like("Brand#1%")).distinct(), "UnitOfMeasurement", key)
    return new_members(named, {k: k for k in key}, seed, "UnitOfMeasurement", key).select(*key, "UnitOfMeasurementGUID")


# --- union of sources (op 42) -------------------------------------------------
UNION_TARGET = T.StructType([
    T.StructField("Source", T.StringType()), T.StructField("Key", T.LongType()),
    T.StructField("Name", T.StringType()), T.StructField("NationKey", T.IntegerType()),
    T.StructField("Balance", T.DoubleType()),
])


@register("union_sources", """
SELECT 'customer' AS Source, c_custkey AS Key, c_name AS Name, c_nationkey AS NationKey,
       c_acctbal AS Balance FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
""")
def q_union_sources(spark, sf_dir):
    t = Tables(spark, sf_dir)
    cust = align(rename_first_target_wins(
        t.customer.withColumn("Source", F.lit("customer")),
        [("c_custkey", "Key"), ("c_name", "Name"), ("c_nationkey", "NationKey"),
         ("c_acctbal", "Balance")]), UNION_TARGET)
    sup = align(rename_first_target_wins(
        t.supplier.withColumn("Source", F.lit("supplier")),
        [("s_suppkey", "Key"), ("s_name", "Name"), ("s_nationkey", "NationKey"),
         ("s_acctbal", "Balance")]), UNION_TARGET)
    return cust.unionByName(sup)


# --- Gold (ops 52, 53, 54) ----------------------------------------------------
# Money is exact: prices and discounts become decimal(18,2) first and the
# line amount is their decimal product, so sums do not depend on float order.
_AMOUNT_SQL = ("(CAST(l_extendedprice AS DECIMAL(18, 2)) "
               "* (1 - CAST(l_discount AS DECIMAL(18, 2))))")


def line_amount():
    return (F.col("l_extendedprice").cast("decimal(18,2)")
            * (1 - F.col("l_discount").cast("decimal(18,2)")))

@register("date_dimension", """
WITH d AS (SELECT CAST(unnest(generate_series(min(l_shipdate)::DATE, max(l_shipdate)::DATE,
                                              INTERVAL 1 DAY)) AS DATE) AS Date FROM lineitem)
SELECT CAST(year(Date) * 10000 + month(Date) * 100 + day(Date) AS INTEGER) AS DateKey, Date,
       CAST(year(Date) AS INTEGER) AS Year, CAST(quarter(Date) AS INTEGER) AS Quarter,
       CAST(month(Date) AS INTEGER) AS Month, monthname(Date) AS MonthName,
       CAST(day(Date) AS INTEGER) AS DayOfMonth, CAST(dayofweek(Date) + 1 AS INTEGER) AS DayOfWeek,
       dayname(Date) AS DayName, dayofweek(Date) IN (0, 6) AS IsWeekend
FROM d
""")
def q_date_dimension(spark, sf_dir):
    return date_dimension_for(spark, Tables(spark, sf_dir).lineitem, "l_shipdate")


@register("fact_build", f"""
SELECT l_orderkey, l_linenumber,
       CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER)
         AS DateKey,
       {g('Account', 'c_name')} AS AccountGUID, {g('Brand', 'p_brand')} AS BrandGUID,
       {g('Category', 'p_type')} AS CategoryGUID, {g('Seller', 's_name')} AS SellerGUID,
       CAST({_AMOUNT_SQL} AS DOUBLE) AS Amount
FROM lineitem
LEFT JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN part ON p_partkey = l_partkey
LEFT JOIN supplier ON s_suppkey = l_suppkey
""")
def q_fact_build(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                           line_amount().alias("Amount"))
    orders = t.orders.select("o_orderkey", "o_custkey")
    cust = t.customer.select("c_custkey", "c_name")
    part = t.part.select("p_partkey", "p_brand", "p_type")
    sup = t.supplier.select("s_suppkey", "s_name")
    # Left joins: a fact whose member is unknown keeps a NULL key, and is kept.
    facts = (li.join(orders, li["l_orderkey"] == orders["o_orderkey"], "left")
             .join(cust, F.col("o_custkey") == cust["c_custkey"], "left")
             .join(part, li["l_partkey"] == part["p_partkey"], "left")
             .join(sup, li["l_suppkey"] == sup["s_suppkey"], "left"))
    # Conformed dimensions key their members by stable_guid(dimension, Name),
    # so the fact's foreign keys follow from the names without another join.
    return facts.select(
        "l_orderkey", "l_linenumber", date_key("l_shipdate"),
        stable_guid("Account", "c_name").alias("AccountGUID"),
        stable_guid("Brand", "p_brand").alias("BrandGUID"),
        stable_guid("Category", "p_type").alias("CategoryGUID"),
        stable_guid("Seller", "s_name").alias("SellerGUID"),
        F.col("Amount").cast("double").alias("Amount"))


_SPEND_SQL = """
SELECT p_type AS Category, CAST(date_trunc('month', l_shipdate) AS DATE) AS Month,
       CAST(sum({amount}) AS DOUBLE) AS Spend,
       count(*) AS Lines
FROM lineitem JOIN part ON p_partkey = l_partkey
GROUP BY {group}
"""


def _spend(spark: SparkSession, sf_dir: str, rollup: bool) -> DataFrame:
    t = Tables(spark, sf_dir)
    li = t.lineitem
    amount = line_amount()
    # Pre-aggregate per (part, month) before the join: a hot part collapses on
    # the map side and the join sees one row per part and month.
    pre = li.groupBy("l_partkey", F.trunc(F.to_date("l_shipdate"), "month").alias("Month")) \
        .agg(F.sum(amount).alias("Spend"), F.count(F.lit(1)).alias("Lines"))
    part = t.part.select("p_partkey", F.col("p_type").alias("Category"))
    joined = pre.join(part, pre["l_partkey"] == part["p_partkey"])
    out = spend_by_category_month(joined, "Category", "Month", "Spend", rollup, lines="Lines")
    return out.withColumn("Spend", F.col("Spend").cast("double"))


@register("spend_by_category_month", _SPEND_SQL.format(group="1, 2", amount=_AMOUNT_SQL))
def q_spend_by_category_month(spark, sf_dir):
    return _spend(spark, sf_dir, rollup=False)


@register("spend_rollup", _SPEND_SQL.format(group="ROLLUP (1, 2)", amount=_AMOUNT_SQL))
def q_spend_rollup(spark, sf_dir):
    return _spend(spark, sf_dir, rollup=True)


# --- spend along a category hierarchy (op 54) ----------------------------------
# A part's category is its type with the words of its name; each word less is a level up.
@register("spend_by_category_tree", f"""
WITH RECURSIVE leaf AS (
  SELECT p_type || ' ' || p_name AS Category, CAST(date_trunc('month', l_shipdate) AS DATE) AS Month,
         sum({_AMOUNT_SQL}) AS Spend, count(*) AS Lines
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
up AS (SELECT DISTINCT Category AS leaf, Category FROM leaf
       UNION ALL SELECT leaf, regexp_replace(Category, ' [^ ]*$', '') FROM up WHERE contains(Category, ' '))
SELECT up.Category, Month, CAST(sum(Spend) AS DOUBLE) AS Spend, CAST(sum(Lines) AS BIGINT) AS Lines
FROM up JOIN leaf ON up.leaf = leaf.Category GROUP BY 1, 2
""")
def q_spend_by_category_tree(spark, sf_dir):
    t = Tables(spark, sf_dir)
    named = t.part.select("p_partkey", F.concat_ws(" ", "p_type", "p_name").alias("Category"))
    words = F.split("Category", " ")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_join(F.slice(words, 1, i), " "))
    links = named.select(F.explode(prefixes).alias("Category")).distinct().select(
        "Category", F.when(F.contains(F.col("Category"), F.lit(" ")), F.regexp_replace("Category", " [^ ]*$", "")).alias("Parent"))
    pre = t.lineitem.groupBy("l_partkey", F.trunc(F.to_date("l_shipdate"), "month").alias("Month")) \
        .agg(F.sum(line_amount()).alias("Spend"), F.count(F.lit(1)).alias("Lines"))
    spend = pre.join(named, pre["l_partkey"] == named["p_partkey"])
    return sums_along(spend, closure(links, "Category", "Parent"), "Category", ["Month"], ["Spend", "Lines"]) \
        .withColumn("Spend", F.col("Spend").cast("double"))


# --- call tree (op 55) --------------------------------------------------------
@register("call_tree", """
WITH RECURSIVE edges AS (
  SELECT 'R' || r_regionkey AS node, CAST(NULL AS VARCHAR) AS parent FROM region
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey FROM customer
  UNION ALL SELECT 'O' || o_orderkey, 'C' || o_custkey FROM orders
), tree AS (
  SELECT node, parent, 0 AS depth, node AS root, node AS path FROM edges
  WHERE parent IS NULL OR parent NOT IN (SELECT node FROM edges)
  UNION ALL
  SELECT e.node, e.parent, t.depth + 1, t.root, t.path || ' > ' || e.node
  FROM edges e JOIN tree t ON e.parent = t.node
)
SELECT node, parent, CAST(depth AS INTEGER) AS depth, root, path FROM tree
""")
def q_call_tree(spark, sf_dir):
    t = Tables(spark, sf_dir)

    def edges(df, node_prefix, node, parent_prefix=None, parent=None):
        p = F.concat(F.lit(parent_prefix), F.col(parent).cast("string")) if parent else \
            F.lit(None).cast("string")
        return df.select(F.concat(F.lit(node_prefix), F.col(node).cast("string"))
                         .alias("ExecutionGUID"), p.alias("ParentExecutionGUID"))

    log = (edges(t.region, "R", "r_regionkey")
           .unionByName(edges(t.nation, "N", "n_nationkey", "R", "n_regionkey"))
           .unionByName(edges(t.customer, "C", "c_custkey", "N", "c_nationkey"))
           .unionByName(edges(t.orders, "O", "o_orderkey", "C", "o_custkey")))
    return call_tree(log)


# --- log sort and severity (ops 41, 51) ---------------------------------------
@register("log_sort_severity", f"""
SELECT event_id, {_ts_text_sql('ts')} AS Begin, event_type AS Action,
       CASE WHEN event_type = 'error' THEN 'Error' ELSE 'Info' END AS Severity
FROM events ORDER BY ts, event_id
""")
def q_log_sort_severity(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    issue = F.when(F.col("event_type") == "error", F.col("event_type"))
    return ev.orderBy("ts", "event_id").select(
        "event_id", log_timestamp("ts").alias("Begin"), F.col("event_type").alias("Action"),
        severity(issue).alias("Severity"))


# --- file names (ops 46, 47, 48) ---------------------------------------------
_NAME_SQL = "regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1)"
_EXT_SQL = (f"CASE WHEN regexp_matches({_NAME_SQL}, '^(.*[^.].*)(\\.[^.]*)$') "
            f"THEN regexp_extract({_NAME_SQL}, '(\\.[^.]*)$', 1) ELSE '' END")
_STEM_SQL = f"left({_NAME_SQL}, length({_NAME_SQL}) - length({_EXT_SQL}))"


@register("error_file_name", f"""
SELECT page_id, {_NAME_SQL} AS file_name, {_EXT_SQL} AS extension, {_STEM_SQL} AS stem,
       (lower({_NAME_SQL}) LIKE '%.csv' OR lower({_NAME_SQL}) LIKE '%.txt') AS accepted,
       {_STEM_SQL} || '.InvalidColumnHeader.ExtraColumns' || {_EXT_SQL} AS error_name,
       {_STEM_SQL} || '.Empty' || {_EXT_SQL} AS empty_name
FROM pages
""")
def q_error_file_name(spark, sf_dir):
    pages = Tables(spark, sf_dir).pages
    named = pages.select("page_id", base_name(F.regexp_replace("url", r"[?#].*$", ""))
                         .alias("file_name"))
    return named.select(
        "page_id", "file_name", extension("file_name").alias("extension"),
        stem("file_name").alias("stem"), has_accepted_extension("file_name").alias("accepted"),
        error_file_name("file_name", F.lit(K.ISSUE_EXTRA)).alias("error_name"),
        error_file_name("file_name", F.lit(K.EMPTY_TAG)).alias("empty_name"))


def queries() -> dict[str, Builder]:
    return {k: fn for k, (fn, _) in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in CATALOG.items() if sql}


# --- the whole Bronze -> Silver -> Gold flow (flagship) -----------------------
@register("medallion_spend", f"""
WITH t AS (
  SELECT CASE WHEN l_returnflag = 'N' THEN 'shop' ELSE 'bank' END AS src,
         l_returnflag = 'N' AND l_linenumber % 2 = 0 AS at_till,
         CAST(l_shipdate AS DATE) AS d,
         CAST({_AMOUNT_SQL} AS DECIMAL(18, 2)) AS amt,
         p_name || ' #' || CAST(p_partkey AS VARCHAR) AS descr, p_type
  FROM lineitem JOIN part ON p_partkey = l_partkey
  WHERE l_returnflag IN ('A', 'N')),
u AS (SELECT DISTINCT src, at_till, year(d) AS y, d, amt, descr, p_type FROM t)
SELECT p_type AS Category, CAST(date_trunc('month', d) AS DATE) AS Month,
       CAST(sum(amt) AS DOUBLE) AS Spend, count(*) AS Lines
FROM u GROUP BY 1, 2
""")
def q_medallion_spend(spark, sf_dir):
    from ledgerline.plans.medallion import medallion_spend

    return medallion_spend(spark, sf_dir)


# --- log rows (ops 44, 45, 49, 50, 51) ---------------------------------------
# Events stand in for pipeline steps: each becomes a log row with a stable
# GUID, a call stack, a timestamp text, a severity and, for failures, the
# formatted error message.
@register("log_rows", f"""
SELECT {g('Event', 'event_id')} AS ExecutionGUID,
       {g('User', 'user_id')} AS ParentExecutionGUID,
       {_ts_text_sql('ts')} AS Begin,
       concat_ws(' > ', 'Main', 'User' || CAST(user_id AS VARCHAR), event_type) AS CallStack,
       CASE WHEN event_type = 'error' THEN 'Error' ELSE 'Info' END AS Severity,
       CASE WHEN event_type = 'error'
            THEN format('Error in {{}} > {{}}() on line {{}}: {{}}', 'events', event_type,
                        CAST(event_id AS VARCHAR), props)
            ELSE 'Success' END AS Result
FROM events
""")
def q_log_rows(spark, sf_dir):
    from ledgerline.functions import call_stack, error_message

    ev = Tables(spark, sf_dir).events
    failed = F.col("event_type") == "error"
    return ev.select(
        stable_guid("Event", "event_id").alias("ExecutionGUID"),
        stable_guid("User", "user_id").alias("ParentExecutionGUID"),
        log_timestamp("ts").alias("Begin"),
        call_stack(call_stack(F.lit("Main"), F.concat(F.lit("User"), F.col("user_id").cast("string"))),
                   "event_type").alias("CallStack"),
        severity(F.when(failed, F.col("event_type"))).alias("Severity"),
        F.when(failed, error_message(F.lit("events"), "event_type",
                                     F.col("event_id").cast("string"), "props"))
        .otherwise(F.lit(K.RESULT_SUCCESS)).alias("Result"))


# --- Bronze file dispositions over table-derived exports (ops 1, 4, 5, 9, 10, 26)
# One export file per source folder and ship year; the 'memo' export carries an
# extra column and is rejected, so its rows are not counted.  Files from orders, one
# per priority or status, lack columns, are of another type or of an unknown source;
# one has a header only.
_DISPOSITIONS_SQL = """
WITH t AS (
  SELECT l_returnflag, l_returnflag = 'N' AND l_linenumber % 2 = 0 AS at_till, year(l_shipdate) AS y
  FROM lineitem),
f AS (
  SELECT CASE WHEN l_returnflag = 'N' THEN 'shop' ELSE 'bank' END AS Source,
         CASE WHEN l_returnflag = 'R' THEN 'Error' ELSE 'Valid' END AS Disposition,
         CASE WHEN l_returnflag = 'R' THEN 'ExtraColumns' ELSE '' END AS Issue,
         at_till, y, count(*) AS n
  FROM t WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY 1, 2, 3, 4, 5),
p AS (SELECT count(DISTINCT o_orderpriority) AS files FROM orders)
SELECT Source, Disposition, Issue, count(*) AS files,
       CASE WHEN Disposition = 'Valid' THEN CAST(sum(n) AS BIGINT) END AS rows
FROM f GROUP BY 1, 2, 3
UNION ALL SELECT 'bank', 'Error', 'MissingColumns', files, NULL FROM p
UNION ALL SELECT 'bank', 'Error', 'ExtraColumns.MissingColumns', files, NULL FROM p
UNION ALL SELECT 'shop', 'Ignored', '', files, NULL FROM p
UNION ALL SELECT 'club', 'NoConfiguration', '', count(DISTINCT o_orderstatus), NULL FROM orders
UNION ALL SELECT 'bank', 'Error', 'Empty', 1, CAST(0 AS BIGINT)
"""


@register("bronze_dispositions", _DISPOSITIONS_SQL)
def q_bronze_dispositions(spark, sf_dir):
    from ledgerline.plans.medallion import bronze_dispositions

    return bronze_dispositions(spark, sf_dir)


# The same files through streams, one per source; landed counts the Bronze rows after a batch
# load that finds nothing left.
@register("stream_dispositions", f"""
SELECT *, CASE WHEN Disposition = 'Valid' THEN rows END AS landed FROM ({_DISPOSITIONS_SQL}) WHERE Source <> 'club'
""")
def q_stream_dispositions(spark, sf_dir):
    from ledgerline.plans.medallion import stream_dispositions

    return stream_dispositions(spark, sf_dir)


# --- splittable scan of fields that run over line ends (op 1) ------------------
@register("quoted_scan", "SELECT * FROM documents")
def q_quoted_scan(spark, sf_dir):
    from ledgerline.plans.medallion import quoted_scan

    return quoted_scan(spark, sf_dir)


# --- layout of whole date columns (op 13) --------------------------------------
# Each event type plays a file type that writes its dates in its own way; sign-ups only
# up to the 12th of the month, so that their layout stays open.
_DATE_TEXT = {"click": "%m/%d/%Y", "view": "%d/%m/%Y", "purchase": "%d.%m.%Y", "error": "%Y-%m-%d", "signup": "%d-%m-%Y"}


@register("infer_layouts", f"""
WITH t AS (
  SELECT event_type, CAST(ts AS DATE) AS day, CASE event_type {" ".join(
      f"WHEN '{k}' THEN strftime(ts, '{v}')" for k, v in _DATE_TEXT.items())} END AS cell
  FROM events WHERE event_type <> 'signup' OR day(ts) <= 12),
n AS (
  SELECT event_type, regexp_extract(cell, '^\\d+([/.-])\\d+[/.-]\\d{{4}}$', 1) AS family, count(*) AS cells,
         count(*) FILTER (WHERE CAST(regexp_extract(cell, '^(\\d+)', 1) AS INT) <= 12) AS month_first,
         count(*) FILTER (WHERE CAST(regexp_extract(cell, '^\\d+.(\\d+)', 1) AS INT) <= 12) AS day_first
  FROM t WHERE event_type <> 'error' GROUP BY 1, 2),
c AS (SELECT *, CASE WHEN month_first > day_first THEN 'M' || family || 'd' || family || 'yyyy'
                     WHEN day_first > month_first THEN 'd' || family || 'M' || family || 'yyyy' END AS layout FROM n)
SELECT t.event_type, c.family, c.cells, c.month_first, c.day_first, c.layout,
       count(*) FILTER (WHERE t.event_type = 'error' OR c.layout IS NOT NULL) AS read_right
FROM t LEFT JOIN c ON t.event_type = c.event_type GROUP BY ALL
""")
def q_infer_layouts(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.where((F.col("event_type") != "signup") | (F.dayofmonth("ts") <= 12))
    java = {"%m": "MM", "%d": "dd", "%Y": "yyyy"}
    cell = F.lit(None).cast("string")
    for kind, text in _DATE_TEXT.items():
        for k, v in java.items():
            text = text.replace(k, v)
        cell = F.when(F.col("event_type") == kind, F.date_format("ts", text)).otherwise(cell)
    cells = ev.select("event_type", F.to_date("ts").alias("day"), cell.alias("cell"))
    counts = layout_counts(cells, ["event_type"], "cell").withColumn("order", chosen_order()) \
        .select(F.col("event_type").alias("_type"), F.col("Family").alias("family"), F.col("Cells").alias("cells"),
                F.col("MonthFirst").alias("month_first"), F.col("DayFirst").alias("day_first"), "order",
                layout_name(F.col("order"), F.col("Family")).alias("layout"))
    known = cells.join(counts, F.col("event_type") == F.col("_type"), "left")
    value = F.when(F.col("family").isNull(), coerce("cell", "date")) \
        .when(F.col("order") == MONTH_FIRST, coerce_ordered("cell", "date", MONTH_FIRST)) \
        .when(F.col("order") == DAY_FIRST, coerce_ordered("cell", "date", DAY_FIRST))
    return known.groupBy("event_type", "family", "cells", "month_first", "day_first", "layout").agg(
        F.sum(F.coalesce(value == F.col("day"), F.lit(False)).cast("bigint")).alias("read_right"))


# --- what a load records about itself (ops 7, 18, 40, 41) ----------------------
# Per source: the Bronze rows whose audit columns point to the run in the log, the
# row count that the run observed, and the run's steps in the order of the log.
@register("load_audit", """
WITH t AS (
  SELECT CASE WHEN l_returnflag = 'N' THEN 'shop' ELSE 'bank' END AS Source,
         l_returnflag = 'N' AND l_linenumber % 2 = 0 AS at_till, year(l_shipdate) AS y
  FROM lineitem WHERE l_returnflag IN ('A', 'N'))
SELECT Source, count(*) AS lines, count(DISTINCT (at_till, y)) AS files,
       (SELECT count(*) FROM t) AS logged_rows,
       'LoadFileToBronze,RetrieveConfigurations,DiscoverInbound,ValidateColumnHeaders,'
       || 'WriteBronze,RecordDispositions' AS steps
FROM t GROUP BY 1
""")
def q_load_audit(spark, sf_dir):
    from ledgerline.plans.medallion import load_audit

    return load_audit(spark, sf_dir)


# --- Silver rows with their audit columns (ops 12, 19, 20, 23) -------------------
# The configuration names no account: each row's comes from a Lookup rule. One rule has no
# entity and one row no column; neither changes anything.
_CUSTOMER_SQL = "'Customer ' || CAST(o_custkey AS VARCHAR)"


@register("silver_rows", f"""
SELECT 'desk' AS Source, 'orders' AS Folder, CAST(o_orderdate AS DATE) AS Date,
       -CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS Amount,
       'ORDER ' || CAST(o_orderkey AS VARCHAR) AS Description, {g('Account', _CUSTOMER_SQL)} AS AccountGUID,
       {g('Brand', "'Brand ' || CAST(o_custkey % 7 AS VARCHAR)")} AS BrandGUID, {g('Category', "'Orders'")} AS CategoryGUID,
       {g('ProductService', "'Order'")} AS ProductServiceGUID, {g('Seller', _CUSTOMER_SQL)} AS SellerGUID,
       'LoadBronzeToSilver' AS Action, true AS in_time
FROM orders
""")
def q_silver_rows(spark, sf_dir):
    from ledgerline.plans.medallion import silver_rows

    return silver_rows(spark, sf_dir)


# --- quarantine of uncastable cells (op 13, set-aside part) --------------------
# Text pieces of each event are coerced; rows with any uncastable cell are set
# aside.  Reported: rows kept and set aside per event type and bad-column set.
@register("quarantine_split", r"""
WITH t AS (
  SELECT event_type,
         trim(regexp_extract(props, ':\s*([^}]*)', 1)) AS k,
         trim(CASE WHEN event_type = 'error' THEN 'n/a-' || CAST(event_id AS VARCHAR)
                   ELSE CAST(value AS VARCHAR) END) AS amount,
         trim(CASE WHEN event_type = 'view' THEN strftime(ts, '%d.%m.%Y')
                   ELSE strftime(ts, '%Y-%m-%d') END) AS day
  FROM events),
c AS (
  SELECT event_type,
         regexp_matches(replace(k, ',', ''), '^[+-]?\d+$') AS k_ok,
         regexp_matches(amount, '{MONEY}') AND regexp_matches(amount, '\d')
           AND regexp_matches(regexp_replace(regexp_replace(amount, '[^0-9.\-]', '', 'g'), '-$', ''), '^-?(\d+\.?\d*|\.\d+)$') AS amount_ok,
         regexp_matches(day, '^\d{4}-\d{1,2}-\d{1,2}$') AS day_ok
  FROM t)
SELECT event_type,
       concat_ws(',', CASE WHEN NOT k_ok THEN 'k' END, CASE WHEN NOT amount_ok THEN 'amount' END,
                 CASE WHEN NOT day_ok THEN 'day' END) AS bad_columns,
       count(*) AS n
FROM c GROUP BY 1, 2
""".replace("{MONEY}", MONEY_SHAPE))
def q_quarantine_split(spark, sf_dir):
    from ledgerline.operators.cleanse import split_quarantine

    ev = Tables(spark, sf_dir).events
    text = ev.select(
        "event_type",
        F.regexp_extract("props", r":\s*([^}]*)", 1).alias("k"),
        F.when(F.col("event_type") == "error",
               F.concat(F.lit("n/a-"), F.col("event_id").cast("string")))
        .otherwise(F.col("value").cast("string")).alias("amount"),
        F.when(F.col("event_type") == "view", F.date_format("ts", "dd.MM.yyyy"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("day"))
    typed = coerce_columns(text, {"k": "int", "amount": "decimal(18,2)", "day": "date"})
    good, bad = split_quarantine(typed, keep_bad_column=True)
    both = good.unionByName(bad)
    return both.groupBy("event_type", F.array_join("_bad_columns", ",").alias("bad_columns")) \
        .agg(F.count(F.lit(1)).alias("n"))
