"""Statistics of whole texts as JVM column expressions (no shuffle, one row at a time)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACES, let, words

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_chars", "n_words", "word_chars", "n_symbols", "n_upper", "n_digits", "n_bangs",
          "n_lines", "n_dup_lines", "n_repeat_words", "n_doubled", "n_distinct")


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def repeated_words(w: Column) -> Column:
    """Number of words inside 3-word windows that the text holds twice or more, first included.

    Most texts repeat no window: their window hashes are all different and nothing
    else is done.  Otherwise the windows themselves are sorted, equal neighbours
    give the positions of repeated windows, and each position covers up to three
    words more than the one before it.
    """
    firsts = F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0)))
    hashes = F.transform(firsts, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    windows = F.sort_array(F.transform(firsts, lambda x, i: F.struct(
        F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("i"))))

    def places(s: Column) -> Column:
        return F.sort_array(F.transform(F.filter(s, lambda x, k: F.coalesce(
            (x.g == F.get(s, k - 1).g), F.lit(False)) | F.coalesce(
            (x.g == F.get(s, k + 1).g), F.lit(False))), lambda x: x.i))

    def covered(p: Column) -> Column:
        return F.aggregate(F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda a, b:
                           F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))),
                           F.lit(0), lambda acc, x: acc + x)

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(
        let(windows, lambda s: let(places(s), covered))))


def text_stats(text: Column) -> Column:
    """A struct of the counts named in ``COUNTS``; a null text counts as empty.

    It is one expression that binds what it needs to lambda variables: a filter on
    its fields that Spark pushes below a projection can't repeat the splitting.
    """
    t = F.coalesce(text, F.lit(""))
    parts = F.struct(t.alias("t"), words(t).alias("w"),
                     F.filter(F.split(t, "\n"), lambda x: _without(x, SPACES) > 0).alias("l"))

    def counted(s: Column) -> Column:
        t, w, l = s.t, s.w, s.l
        counts = {
            "n_chars": F.length(t),
            "n_words": F.size(w),
            "word_chars": _without(t, SPACES),
            "n_symbols": F.length(t) - _without(t, SYMBOLS),
            "n_upper": F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}", "")),
            "n_digits": F.length(t) - _without(t, "0123456789"),
            "n_bangs": F.length(t) - _without(t, "!?"),
            "n_lines": F.size(l),
            "n_dup_lines": F.size(l) - F.size(F.array_distinct(l)),
            "n_repeat_words": repeated_words(w),
            "n_doubled": F.size(F.filter(w, lambda x, i: F.coalesce(x == F.get(w, i - 1), F.lit(False)))),
            "n_distinct": F.size(F.array_distinct(w)),
        }
        return F.struct(*[counts[c].cast("long").alias(c) for c in COUNTS])

    return let(parts, counted)
