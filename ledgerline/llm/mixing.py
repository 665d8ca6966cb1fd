"""Mixing sources to target weights by pivotal dependent rounding.

A source's words are taken ``rate = target / size`` times.  Every document is
copied ``floor(rate)`` times, and once more with a fractional probability; these
fractions are rounded together, not one by one.  Two documents meet and probability
moves from one to the other, weighted by their words, until one of the two is 0 or
1.  Which way it moves is drawn so that each document keeps its expected copies,
while the expected words of the pair do not change at all.  The document that is
still fractional meets the next one.  At the end of a source one document is left,
so a source misses its target by less than one document, as a rule a short one: the
longest meet first.

The work is a reduction tree.  Documents are dealt by hash into bundles of about
``BUNDLE`` per source, a bundle is rounded by one ``aggregate`` over its array and
hands on its one undecided document, and these meet in bundles again until a source
has one bundle.  No bundle holds more than a few hundred rows however large a source
is.  Draws are hashes of the document ids and the seed, so reruns agree.

Only one row a source (name, words, documents) is ever sorted in one place; the
number of sources is taken to be a list, not data.

Defined cases: null or blank texts have no words and are taken 0 times; null sources
form one source, sorted last; an empty table gives an empty result; rows that repeat
an id are rounded apart, each by its own number of words.  Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import checkpointed, count_words

BUNDLE = 128
MAX_COPIES = 3
WEIGHTS = (5.0, 2.0, 1.0)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   max_copies: int = MAX_COPIES, share: float = 1.0) -> DataFrame:
    """(source, source_size, docs) with ``target`` and ``rate``, the copies per document.

    Weights repeat over the sources in code point order, null last.  A target is at
    most ``max_copies`` times its source; what is above goes to the others by weight.
    Fill all to a level ``y``: target = min(cap, y * weight).  With sources in the
    order of cap / weight the level follows from running sums.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"))
    capped = (sizes.withColumn("weight", w)
              .withColumn("cap", (F.col("source_size") * max_copies).cast("double"))
              .withColumn("fill", F.col("cap") / F.col("weight")))
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy(F.lit(0))
    total = F.sum("source_size").over(all_rows) * F.lit(float(share))
    filled = F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    levels = capped.withColumn("level", (total - filled) / open_weight)
    # The level holds from the first source that it doesn't fill up.
    level = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "level"))).over(all_rows)
    return (levels.withColumn("at", F.coalesce(level["level"], F.col("fill")))
            .withColumn("target", F.least(F.col("cap"), F.col("at") * F.col("weight")))
            .withColumn("rate", F.when(F.col("source_size") > 0, F.least(
                F.col("target") / F.col("source_size"), F.lit(float(max_copies)))).otherwise(0.0))
            .select("source", "source_size", "docs", "target", "rate"))


def _meet(a: Column, b: Column, draw: Column) -> tuple[Column, Column]:
    """Probabilities of ``a`` and ``b`` (structs with p and size) after they met."""
    to_a = F.least((1 - a.p) * a["size"], b.p * b["size"])
    to_b = F.least(a.p * a["size"], (1 - b.p) * b["size"])
    up = draw * (to_a + to_b) < to_b  # chance to_b / (to_a + to_b): expectations stay
    fills_a, empties_a = (1 - a.p) * a["size"] <= b.p * b["size"], a.p * a["size"] <= (1 - b.p) * b["size"]
    p_a = F.when(up, F.when(fills_a, 1.0).otherwise(a.p + to_a / a["size"])).otherwise(
        F.when(empties_a, 0.0).otherwise(a.p - to_b / a["size"]))
    p_b = F.when(up, F.when(~fills_a, 0.0).otherwise(b.p - to_a / b["size"])).otherwise(
        F.when(~empties_a, 1.0).otherwise(b.p + to_b / b["size"]))
    return p_a, p_b


def _unit(*cols) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / float(1 << 53)


def _round_bundle(units: Column, seed: int) -> Column:
    """Fold an array of (key, n, p, size): decided units, and the one still open."""
    unit = "struct<key:bigint,n:bigint,p:double,size:double>"
    first = F.get(units, 0)
    start = F.struct(F.struct(first["key"].alias("key"), first.n.alias("n"), first.p.alias("p"),
                              first["size"].alias("size")).cast(unit).alias("open"),
                     F.array().cast("array<struct<key:bigint,n:bigint,up:int>>").alias("done"))

    def step(acc: Column, b: Column) -> Column:
        a = acc.open
        p_a, p_b = _meet(a, b, _unit(F.lit(seed), a["key"], a.n, b["key"], b.n))
        rounded = F.transform(F.array(F.struct(p_a.alias("pa"), p_b.alias("pb"))), lambda x: F.struct(
            # a is decided if it became integral; else b is
            F.when((x.pa <= 0) | (x.pa >= 1), F.struct(b["key"].alias("key"), b.n.alias("n"), x.pb.alias("p"), b["size"].alias("size")))
            .otherwise(F.struct(a["key"].alias("key"), a.n.alias("n"), x.pa.alias("p"), a["size"].alias("size"))).alias("open"),
            F.when((x.pa <= 0) | (x.pa >= 1), F.struct(a["key"].alias("key"), a.n.alias("n"), (x.pa >= 1).cast("int").alias("up")))
            .otherwise(F.struct(b["key"].alias("key"), b.n.alias("n"), (x.pb >= 1).cast("int").alias("up"))).alias("one")))[0]
        return F.transform(F.array(rounded), lambda r: F.struct(
            r.open.cast(unit).alias("open"),
            F.concat(acc.done, F.array(r.one.cast("struct<key:bigint,n:bigint,up:int>"))).alias("done")))[0]

    return F.aggregate(F.slice(units, 2, F.greatest(F.size(units) - 1, F.lit(1))), start, step)


def round_fractions(units: DataFrame, docs_per_source: int, seed: int) -> DataFrame:
    """(key, n, up) of units (source, key, n, p, size); up is 1 for one copy more.

    Each level of the tree deals the units of a source into bundles and rounds each;
    ``docs_per_source`` (of the largest source) gives the number of levels.
    """
    decided, level_units, left = None, units, max(1, docs_per_source)
    level = 0
    while True:
        bundles = math.ceil(left / BUNDLE)
        dealt = F.pmod(F.xxhash64(F.lit(seed + level), "key", "n"), F.lit(bundles)) if bundles > 1 else F.lit(0)
        folded = (level_units.withColumn("bundle", dealt).groupBy("source", "bundle")
                  # the longest first: what stays open to the end is short
                  .agg(F.sort_array(F.collect_list(F.struct("size", "key", "n", "p")), asc=False).alias("units"))
                  .select("source", _round_bundle(F.col("units"), seed + level).alias("r")))
        folded = checkpointed(folded)
        done = folded.select(F.inline("r.done"))
        decided = done if decided is None else decided.unionByName(done)
        level_units = folded.select("source", "r.open.*")
        if bundles == 1:
            break
        left, level = bundles, level + 1
    last = level_units.select("key", "n", (_unit(F.lit(seed), F.lit("last"), "key", "n") < F.col("p"))
                              .cast("int").alias("up"))
    return decided.unionByName(last)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[float, ...] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = 17) -> DataFrame:
    """One row per input row: key, source, size, source_size, target, copies, taken."""
    sized = checkpointed(docs.select(F.col(f"`{key}`").cast("long").alias("key"),
                                     F.col(f"`{source}`").alias("source"),
                                     count_words(F.col(f"`{text}`")).cast("long").alias("size")))
    sources = checkpointed(source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")),
        weights, max_copies).coalesce(1))
    most = sources.agg(F.max("docs")).first()[0] or 0
    # Rows of one id and size are told apart by their place among each other.
    again = Window.partitionBy("key", "size").orderBy("source")
    told = sized.withColumn("n", F.row_number().over(again).cast("long") * (1 << 40) + F.col("size"))
    rated = told.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rated = checkpointed(rated.withColumn("whole", F.floor("rate")).withColumn("p", F.col("rate") - F.col("whole")))
    units = (rated.where((F.col("size") > 0) & (F.col("p") > 0))
             .select("source", "key", "n", "p", F.col("size").cast("double").alias("size")))
    up = round_fractions(units, most, seed).where("up = 1").select(
        F.col("key").alias("up_key"), F.col("n").alias("up_n"), "up").alias("u")
    joined = rated.join(up, F.col("key").eqNullSafe(F.col("up_key")) & (F.col("n") == F.col("up_n")), "left")
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("up", F.lit(0))).otherwise(0).cast("long")
    return joined.select(F.col("key").alias(key), "source", "size", "source_size", "target",
                         copies.alias("copies"), (copies * F.col("size")).alias("taken"))
