"""Joins by order: the last row before a time, and intervals that overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import written_once

#: Rows of both sides in one range of keys and times.
RANGE_ROWS = 1 << 20


def asof_join(left: DataFrame, right: DataFrame, by: str, time: str, tie: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All rows of `left` with `match`, the newest row of `right` with the same `by` that is not later, as a struct.

    Of right rows with one time the one with the largest `tie` counts, nulls of `tie` first. A left row with a null key or time, or nothing before
    it, has a null match. Both sides are laid out once by ranges of key and time, of about `range_rows` rows each, so a key with many rows lies
    in many ranges. Within a range the last right row is carried forward in order; from range to range only each key's last right row
    goes on, which is a row per key and range at most. Rows alike in key and time share a range.
    """
    keys = {"_key": F.col(by), "_time": F.col(time)}
    known = F.col(by).isNotNull() & F.col(time).isNotNull()
    nothing = F.lit(None).cast(right.select(F.struct(*right.columns)).schema[0].dataType)
    rights = right.where(known).select(
        *(c.alias(n) for n, c in keys.items()), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), F.struct(*right.columns).alias("_right")
    )
    lefts = left.where(known).select(*(c.alias(n) for n, c in keys.items()), F.lit(1).alias("_side"), nothing.alias("_right"), F.struct(*left.columns).alias("_left"))
    both = rights.unionByName(lefts, allowMissingColumns=True)
    ranges = max(1, -(-both.count() // range_rows))
    # The number of a row's range is written with it, so that a lost task cannot deal the rows another way.
    laid = written_once(both.repartitionByRange(ranges, "_key", "_time").withColumn("_range", F.spark_partition_id()), "ordered")
    last = F.max_by("_right", F.struct("_time", "_tie"))
    ends = laid.where("_side = 0").groupBy("_key", "_range").agg(last.alias("_last"))
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # Ranges without a right row of the key need the carried one too.
    present = laid.where("_side = 1").select("_key", "_range").distinct()
    carried = (
        present.join(ends, ["_key", "_range"], "full")
        .withColumn("_carried", F.last("_last", ignorenulls=True).over(before))
        .select("_key", "_range", "_carried")
        .where("_carried IS NOT NULL")
    )
    inside = Window.partitionBy("_key", "_range").orderBy("_time", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    nearest = laid.withColumn("_here", F.last("_right", ignorenulls=True).over(inside)).where("_side = 1")
    matched = nearest.join(carried, ["_key", "_range"], "left")
    found = matched.select("_left.*", F.coalesce("_here", "_carried").alias("match"))
    return found.union(left.where(~known).select("*", nothing.alias("match")))


def overlapping(left: DataFrame, right: DataFrame, by: str, start: str, end: str, width: float = 1.0) -> DataFrame:
    """`a` and `b`, rows of both sides as structs, for all pairs with the same `by` whose closed intervals have a number in common.

    An interval lies at the level of its length, where cells are `width` times a power of two and at least as long as it, and so in
    two cells at most; a pair meets at the higher of its levels, in the cell of its later start. So a long interval is not cut into
    many short cells, and two short ones do not meet in a long cell. `width` changes the cost, never the result. A row with
    a null key, a null or infinite end, or an end before its start has no partner; repeated rows give a pair each.
    """

    def placed(df: DataFrame, name: str) -> DataFrame:
        low, high = F.col(start).cast("double"), F.col(end).cast("double")
        usable = F.col(by).isNotNull() & (F.abs(low) < float("inf")) & (F.abs(high) < float("inf")) & (F.col(start) <= F.col(end))
        level = F.greatest(F.lit(0), F.ceil(F.log2((high - low) / width))).cast("int")
        # Columns lie side by side until the pairs are found: those that nobody asks for are not moved. A filter would be pushed
        # below what computes the ends, which is then computed many times; a row without a level gets no cell instead.
        return df.select(
            F.col(by).alias("_key"),
            F.when(usable, F.coalesce(F.when(high > low, level), F.lit(0))).alias("_own"),
            F.col(start).alias(f"_{name}_start"),
            F.col(end).alias(f"_{name}_end"),
            *(F.col(c).alias(f"_{name}_{i}") for i, c in enumerate(df.columns)),
        )

    def cell(of: Column) -> Column:
        return F.floor(of.cast("double") / (F.lit(float(width)) * F.pow(F.lit(2.0), F.col("_level"))))

    def cells(df: DataFrame, name: str) -> DataFrame:
        each = F.explode(F.sequence(cell(F.col(f"_{name}_start")), cell(F.col(f"_{name}_end"))))
        return df.withColumn("_cell", each).drop("_own")

    a, b = placed(left, "a"), placed(right, "b")
    # As many numbers as lengths have powers of two: 2,100 for any doubles.
    owned = a.select(F.lit("a").alias("side"), "_own").union(b.select(F.lit("b").alias("side"), "_own")).distinct().collect()
    of_a, of_b = (sorted(r["_own"] for r in owned if r["side"] == side and r["_own"] is not None) for side in "ab")

    def own(df: DataFrame, levels: list[int] | None = None) -> DataFrame:
        meets = F.col("_own").isNotNull() if levels is None else F.col("_own").isin(levels)
        return df.withColumn("_level", F.explode(F.when(meets, F.array("_own"))))

    # Only to levels where the other side has intervals of its own.
    def above(df: DataFrame, levels: list[int]) -> DataFrame:
        levels = F.array(*map(F.lit, levels)).cast("array<int>")
        return df.withColumn("_level", F.explode(F.filter(levels, lambda x: x > F.col("_own"))))

    def struct(df: DataFrame, name: str) -> Column:
        return F.struct(*(F.col(f"_{name}_{i}").alias(c) for i, c in enumerate(df.columns))).alias(name)

    def pairs(x: DataFrame, y: DataFrame) -> DataFrame:
        # Estimates do not see what was exploded on the way: they are too low to broadcast a side on.
        met = cells(x, "a").join(cells(y, "b").hint("merge"), ["_key", "_level", "_cell"])
        overlap = (F.col("_a_start") <= F.col("_b_end")) & (F.col("_b_start") <= F.col("_a_end"))
        return met.where(overlap & (cell(F.greatest("_a_start", "_b_start")) == F.col("_cell"))).select(struct(left, "a"), struct(right, "b"))

    # What has no level to meet at is not read again.
    met_by_a = above(b, of_a)
    if set(of_a) & set(of_b):
        met_by_a = met_by_a.union(own(b, of_a))
    found = pairs(own(a), met_by_a)
    longer = [x for x in of_b if x > min(of_a, default=x)]
    return found.union(pairs(above(a, longer), own(b, longer))) if longer else found
