"""Records of delimited text whose fields may run over line ends, read in splits.

Text is split at line ends, so a split may begin inside a qualified field.  What a line does to the
state "inside a qualified field" is one of four maps, found from the line alone for both
states it may begin in.  The maps of a split's lines compose to the split's map, those of
a file's splits give the state that each split begins in, and then every line's.  Lines that begin
outside a field begin a record.  Only pieces of records that cross a split are put together
across splits.

The state follows the parser: a qualifier opens a field only at its start; inside, two in a row
stand for one, another closes the field; in a field that doesn't begin with one it is text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What a line does: nothing, change the state, end outside, end inside a qualified field.
KEEP, CHANGE, OUTSIDE, INSIDE = range(4)
# Places in a line: in a plain field, at a field's start, in a qualified field, after a qualifier in one.
_PLAIN, _START, _IN, _AFTER = range(4)


def transition(line: Column, delimiter: Column, qualifier: Column) -> Column:
    """What ``line`` does to the state, as one of the four maps."""
    pieces = F.split(line, F.concat(F.lit("\\Q"), qualifier, F.lit("\\E")), -1)

    def at_field(piece: Column, otherwise: int) -> Column:
        return F.when(F.endswith(piece, delimiter), _START).otherwise(otherwise)

    def step(place: Column, piece: Column) -> Column:  # a qualifier, then the text up to the next
        return (F.when((place == _START) | (place == _AFTER), _IN)
                .when((place == _IN) & (piece == ""), _AFTER)
                .otherwise(at_field(piece, _PLAIN)))

    def inside_after(begin: Column) -> Column:
        return F.aggregate(F.slice(pieces, 2, F.size(pieces)), begin, step) == _IN

    first = F.get(pieces, F.lit(0))
    from_outside = inside_after(F.when(first == "", _START).otherwise(at_field(first, _PLAIN)))
    from_inside = inside_after(F.lit(_IN))
    found = (F.when(~from_outside & from_inside, KEEP).when(from_outside & ~from_inside, CHANGE)
             .when(from_outside, INSIDE).otherwise(OUTSIDE))
    return F.when(F.contains(line, qualifier), found).otherwise(KEEP)


def _inside_before(df: DataFrame, keys: list[str], order: str, kind: str, begin: Column) -> DataFrame:
    """Adds ``inside``: the state before each row, when the rows' maps apply in order from ``begin``.

    The last row that fixes the state decides, and the number of changes since."""
    upto = Window.partitionBy(*keys).orderBy(order)
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_changes", F.sum((F.col(kind) == CHANGE).cast("int")).over(upto))
    fixed = F.when(F.col(kind) >= OUTSIDE, F.struct((F.col(kind) - OUTSIDE).alias("state"), F.col("_changes").alias("changes")))
    df = df.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(before)) \
        .withColumn("_before", F.coalesce(F.lag("_changes").over(upto), F.lit(0)))
    state = F.coalesce(F.col("_fixed.state"), begin.cast("int")) + F.col("_before") - F.coalesce(F.col("_fixed.changes"), F.lit(0))
    return df.withColumn("inside", F.pmod(state, F.lit(2)) == 1).drop("_changes", "_fixed", "_before")


def split_states(lines: DataFrame) -> DataFrame:
    """(path, block, inside, open_end, owner, n_lines) of every split.

    ``inside``: it begins inside a field; ``open_end``: it ends in one; ``owner``: the
    split in which the record began that is open where this one begins.
    """
    # Only the lines that do something are gathered: their place and map in one number.
    moves = F.sort_array(F.collect_list(F.when(F.col("kind") != KEEP, F.col("id") * 4 + F.col("kind"))))
    splits = lines.groupBy("path", "block").agg(moves.alias("moves"), F.count(F.lit(1)).alias("n_lines"))

    def end(begin: int) -> Column:
        return F.aggregate("moves", F.lit(begin), lambda state, m: F.when(m % 4 == CHANGE, 1 - state)
                           .otherwise((m % 4 - OUTSIDE).cast("int")))

    closes = F.exists("moves", lambda m: (m % 4 == CHANGE) | (m % 4 == OUTSIDE))
    splits = splits.select("path", "block", "n_lines", closes.alias("closes"),
                           (end(0) == 1).alias("end0"), (end(1) == 1).alias("end1"))
    kind = (F.when(~F.col("end0") & F.col("end1"), KEEP).when(F.col("end0") & ~F.col("end1"), CHANGE)
            .when(F.col("end0"), INSIDE).otherwise(OUTSIDE))
    splits = _inside_before(splits.withColumn("kind", kind), ["path"], "block", "kind", F.lit(0)) \
        .withColumn("open_end", F.when(F.col("inside"), F.col("end1")).otherwise(F.col("end0")))
    begins = F.col("open_end") & (~F.col("inside") | F.col("closes"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumn("owner", F.last(F.when(begins, F.col("block")), ignorenulls=True).over(earlier)) \
        .select("path", "block", "inside", "open_end", "owner", "n_lines")


def assemble(lines: DataFrame) -> DataFrame:
    """(path, first_id, record) from lines (path, block, id, line, kind).

    Lines are dealt out once, by split; a split's lines are one task's at most, so a file
    of any size is read by as many tasks as it has splits.
    """
    states = split_states(lines).select(
        F.col("path").alias("_path"), F.col("block").alias("_block"), F.col("inside").alias("_inside"), "open_end", "owner", "n_lines")
    joined = lines.join(states, (F.col("path") == F.col("_path")) & (F.col("block") == F.col("_block")))
    placed = _inside_before(joined, ["path", "block"], "id", "kind", F.col("_inside"))
    upto = Window.partitionBy("path", "block").orderBy("id")
    placed = placed.withColumn("number", F.sum((~F.col("inside")).cast("int")).over(upto)) \
        .withColumn("last", F.row_number().over(upto) == F.col("n_lines"))
    parts = placed.groupBy("path", "block", "number").agg(
        F.min("id").alias("first_id"), F.sort_array(F.collect_list(F.struct("id", "line"))).alias("lines"),
        (F.max("last") & F.first("open_end")).alias("tail"), F.first("owner").alias("owner"))
    parts = parts.select(
        "path", "block", "first_id", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("record"),
        F.when(F.col("number") == 0, F.col("owner")).when(F.col("tail"), F.col("block")).alias("owner"))
    whole = parts.where(F.col("owner").isNull()).select("path", "first_id", "record")
    pieces = F.sort_array(F.collect_list(F.struct("block", "record", "first_id")))
    crossing = parts.where(F.col("owner").isNotNull()).groupBy("path", "owner").agg(pieces.alias("pieces")).select(
        "path", F.get("pieces", F.lit(0))["first_id"].alias("first_id"),
        F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(crossing)
