r"""Benchmark decontamination on templates: re-parameterised questions match too.

Canonical form of a text: numbers, names and units become typed placeholders,
punctuation and case go.  A *name* is a capitalised word that follows, after one
space, a word that ends no sentence; a *number* is a word that starts with a digit
(after a sign, bracket or currency sign); a *unit* is a listed word right after a
number.  Windows of ``WINDOW`` template words with at least ``LITERALS`` words that
are no placeholders are hashed and joined with those of the benchmark items; the
windows' words are compared after the hash.  Items of ``LITERALS`` to ``WINDOW - 1``
words have one window of their own length.

Windows of one document and item at the same distance form an alignment.  A window whose
slots hold the item's own values counts as it is.  Changed values must correspond one to one over the
alignment, so that "3 apples and 3 pears" matches "5 apples and 5 pears", not "5 apples and 7
pears": of the changes of one value, and of the changes to one value, that seen most
often holds (ties: the smaller new value, the smaller old one), and windows with another change don't
count.  A document leaks an item if ``LEAST`` windows of an alignment count (all, if the item has
fewer): one edited number in a verbatim copy costs the windows around it at most.

Scale: each document's windows stay in its row; they are probed against the distinct
hashes of the benchmark, which are broadcast only while there are at most
``BROADCAST_WINDOWS`` (8 bytes each).  With more, (document, place, hash) is shuffled
and joined.  What follows has only the matching windows.

Defined cases: null and blank texts match nothing; a null id is an id like others;
rows that repeat an id are judged by their own text; items without a window with
enough literal words match nothing; an empty table on either side gives no leaks.
Extra columns, whatever their names, are ignored by ``find_leaks`` and kept by ``drop_leaks``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import checkpointed, let, unused, words

WINDOW, LITERALS, LEAST = 8, 5, 6
BROADCAST_WINDOWS = 1_000_000

# Units of measure that follow a number.
UNITS = (
    "mm", "cm", "m", "km", "in", "ft", "yd", "mi", "inch", "inches", "foot", "feet", "yard", "yards",
    "mile", "miles", "meter", "meters", "metre", "metres", "kilometers", "kilometres", "mg", "g", "kg",
    "lb", "lbs", "oz", "gram", "grams", "kilogram", "kilograms", "pound", "pounds", "ton", "tons", "ml",
    "l", "liter", "liters", "litre", "litres", "second", "seconds", "minute", "minutes", "hour", "hours",
    "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "cent",
    "cents", "euro", "euros", "percent", "degrees", "kmh", "mph",
)
NAME = r"(?<=[^\x20\x09-\x0D.!?:;] )\p{Lu}(?=\p{Ll})"
NUMBER = r"(^|[\x20\x09-\x0D])([\p{Sc}+(\-]?[0-9][^\x20\x09-\x0D]*)"
UNIT = "(\x02[^\\x20\\x09-\\x0D]+ )(" + "|".join(UNITS) + r")($|[^\p{L}\p{N}])"
PUNCTUATION = "[^\\p{L}\\p{M}\\p{N}\x01-\x03\\x20\\x09-\\x0D]+"


def canonical(text: Column) -> Column:
    """Lower-case words without punctuation; names, numbers and units start with \\x01, \\x02, \\x03."""
    def marked(t: Column) -> Column:
        numbered = F.regexp_replace(F.regexp_replace(t, NUMBER, "$1\x02$2"), UNIT, "$1\x03$2$3")
        return F.when(t.rlike("[0-9]"), numbered).otherwise(t)

    t = let(F.regexp_replace(F.coalesce(text, F.lit("")), NAME, "\x01$0"), marked)
    return F.lower(F.regexp_replace(t, PUNCTUATION, ""))


def _tokens(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys and raw, the canonical words with the values of the slots."""
    return df.select(*keys, let(canonical(F.col("_text")), words).alias("raw"))


def _template(raw: Column) -> Column:
    return F.transform(raw, lambda w: F.when(w < "\x04", F.substring(w, 1, 1)).otherwise(w))


def _window_hashes(raw: Column, size: int) -> Column:
    """The hash of every window of ``size`` template words, in order.

    What is used twice is bound to lambda variables: a filter that Spark pushes below
    can't repeat the splitting per word.
    """
    def rolled(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.greatest(F.size(h) - (size - 1), F.lit(0))),
                           lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, size)]))

    return let(F.transform(raw, lambda w: F.xxhash64(F.when(w < "\x04", F.substring(w, 1, 1)).otherwise(w))), rolled)


def _window(tokens: Column, place: Column, size: Column) -> Column:
    return F.slice(tokens, place + 1, size)


def _slots(raw: Column) -> Column:
    return F.filter(raw, lambda w: w < "\x04")


def benchmark_windows(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """One row per window of an item that has enough literal words."""
    tok = _tokens(items.select(F.col(f"`{item}`").alias("item_id"), F.col(f"`{text}`").alias("_text")),
                  ["item_id"])
    n = F.size("raw")
    hashed = F.when(n >= WINDOW, _window_hashes(F.col("raw"), WINDOW))
    for size in range(LITERALS, WINDOW):
        hashed = hashed.when(n == size, _window_hashes(F.col("raw"), size))
    cut = checkpointed(tok.withColumn("size", F.least(n, F.lit(WINDOW))).withColumn("hs", hashed))
    cut = cut.select("item_id", "size", "raw", F.posexplode("hs").alias("ip", "h")).withColumn(
        "iraw", _window(F.col("raw"), F.col("ip"), F.col("size")))
    out = cut.select("item_id", "size", "ip", "h", _template(F.col("iraw")).alias("iwords"), _slots(F.col("iraw")).alias("islots"))
    out = checkpointed(out.where(F.col("size") - F.size("islots") >= LITERALS))
    n_windows = out.groupBy(F.col("item_id").alias("of")).agg(F.count("*").cast("int").alias("item_windows"))
    return out.join(n_windows, F.col("item_id").eqNullSafe(F.col("of"))).drop("of")


def _matches(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """Windows of documents whose hash the benchmark has: id, text_hash, p, h, words, slots."""
    hashes = checkpointed(bench.groupBy("h").agg(F.min("size").alias("size")))
    few = hashes.count() <= BROADCAST_WINDOWS
    found = None
    # As a rule one size; shorter items add WINDOW - LITERALS others at most.
    for size in sorted({WINDOW} | {r[0] for r in hashes.select("size").distinct().collect()}):
        known = hashes.where(F.col("size") == size).select("h")
        tok = _tokens(docs, ["id", "text_hash"])
        hs = _window_hashes(F.col("raw"), size)
        if few:
            # The words travel beside the windows by reference; only what matches is copied.
            part = (tok.select("id", "text_hash", "raw", F.posexplode_outer(hs).alias("p", "h"))
                    .join(F.broadcast(known), "h", "left_semi"))
        else:
            places = (tok.select("id", "text_hash", F.posexplode_outer(hs).alias("p", "h"))
                      .join(known, "h", "left_semi")
                      .groupBy("id", "text_hash").agg(F.collect_set(F.struct("p", "h")).alias("found"))
                      .withColumnsRenamed({"id": "fid", "text_hash": "ftext"}))
            part = (tok.join(places, F.col("id").eqNullSafe(F.col("fid")) & (F.col("text_hash") == F.col("ftext")))
                    .select("id", "text_hash", "raw", F.inline("found")))
        part = part.select("id", "text_hash", "p", "h", _window(F.col("raw"), F.col("p"), F.lit(size)).alias("raw"))
        found = part if found is None else found.unionByName(part)
    return found.select("id", "text_hash", "p", "h", _template(F.col("raw")).alias("words"), _slots(F.col("raw")).alias("slots"))


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    t = F.col(f"`{text}`")
    return docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(t).alias("text_hash"), t.alias("_text"))


ALIGNMENT = ["id", "text_hash", "item_id", "at"]


def _inconsistent(met: DataFrame) -> DataFrame:
    """(*ALIGNMENT, p) of windows with a change that another change of the same old or new value outvotes."""
    changes = met.select(*ALIGNMENT, "p", F.explode(F.filter("pairs", lambda x: x.i != x.d)).alias("c")) \
        .select(*ALIGNMENT, "p", "c.i", "c.d")
    votes = changes.groupBy(*ALIGNMENT, "i", "d").agg(F.count("*").alias("votes"))
    of_old = Window.partitionBy(*ALIGNMENT, "i").orderBy(F.desc("votes"), "d")
    of_new = Window.partitionBy(*ALIGNMENT, "d").orderBy(F.desc("votes"), "i")
    lost = votes.select(*ALIGNMENT, "i", "d", F.row_number().over(of_old).alias("a"), F.row_number().over(of_new).alias("b")) \
        .where((F.col("a") > 1) | (F.col("b") > 1)).drop("a", "b")
    return _joined(changes, lost, [*ALIGNMENT, "i", "d"], "left_semi").select(*ALIGNMENT, "p").distinct()


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join on columns that may hold null, null to null."""
    other = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return left.join(other, reduce(lambda x, y: x & y, same), how)


def _leaks(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """id, text_hash, item_id, n_windows, item_windows, slots of leaked items."""
    found = checkpointed(_matches(docs, bench)).distinct()
    # A window of an item can stand at several places; an alignment holds each once.
    met = checkpointed(
        found.join(bench.drop("size"), "h").where(F.col("words") == F.col("iwords"))
        .select("id", "text_hash", "item_id", "item_windows", (F.col("p") - F.col("ip")).alias("at"), "p",
                F.zip_with("islots", "slots", lambda a, b: F.struct(a.alias("i"), b.alias("d"))).alias("pairs")))
    counted = _joined(met, _inconsistent(met), [*ALIGNMENT, "p"], "left_anti")
    lined = counted.groupBy(*ALIGNMENT, "item_windows").agg(
        F.count("*").alias("n_windows"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    changed = F.size(F.filter("pairs", lambda x: x.i != x.d))
    return (lined.where(F.col("n_windows") >= F.least(F.lit(LEAST), F.col("item_windows")))
            .groupBy("id", "text_hash", "item_id", "item_windows")
            .agg(F.max("n_windows").alias("n_windows"), F.min(changed).alias("changed_slots")))


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
               item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per (document id, item) that leaks: n_windows matched of item_windows, changed_slots."""
    bench = checkpointed(benchmark_windows(items, item, item_text))
    return (_leaks(_keyed(docs, key, text), bench).groupBy(F.col("id").alias(key), "item_id", "item_windows")
            .agg(F.max("n_windows").alias("n_windows"), F.min("changed_slots").alias("changed_slots")))


def drop_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
               item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, with their columns as they were."""
    bench = checkpointed(benchmark_windows(items, item, item_text))
    leak_id, leak_text = unused("_leak_id", docs), unused("_leak_text", docs)
    bad = checkpointed(_leaks(_keyed(docs, key, text), bench).select(
        F.col("id").alias(leak_id), F.col("text_hash").alias(leak_text)).distinct())
    return docs.join(bad, F.col(f"`{key}`").eqNullSafe(F.col(leak_id))
                     & (F.xxhash64(F.col(f"`{text}`")) == F.col(leak_text)), "left_anti")
