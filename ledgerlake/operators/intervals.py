"""Points in ranges as an equi-join that yields matches only.

A date range is the disjoint union of few dyadic blocks (2**level days, aligned),
at most two of a level. A date lies in one block of each level. So a range is
exploded to its blocks and a date to the blocks around it, and both meet on the
block: each match is found exactly once and nothing else is, however long or
dense the ranges are and however many dates share a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.operators.flags import bounded

LEVELS = 22  # blocks of up to 2**21 days; the dates from year 1 to 9999 span fewer than 2**22
FIRST_DAY = 719_162  # days from 0001-01-01 to 1970-01-01


def day_number(date: Column) -> Column:
    return F.unix_date(date.cast("date")).cast("long") + F.lit(FIRST_DAY)


def _block(level: Column, number: Column) -> Column:
    return F.call_function("shiftleft", level.cast("long"), F.lit(32)) + number


def blocks_of_range(start: Column, end: Column) -> Column:
    """The dyadic blocks whose union is the days from `start` to `end`, none where that is empty or a bound is NULL."""
    lo, after = day_number(start), day_number(end) + F.lit(1)

    def at(level: Column) -> Column:
        # days rounded inwards to whole blocks; an odd one at either end is not part of a block of the next level
        width = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        left, right = F.call_function("shiftright", lo + width - F.lit(1), level), F.call_function("shiftright", after, level)
        some = left < right
        return F.array(F.when(some & (left % 2 == 1), _block(level, left)), F.when(some & (right % 2 == 1), _block(level, right - 1)))

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), at)))


def blocks_around(date: Column, levels: list[int]) -> Column:
    """The block of each level that holds the date."""
    day = day_number(date)
    return F.array(*[F.lit(k << 32) + F.shiftright(day, k) for k in levels]) if levels else F.array().cast("array<long>")


def points_in_ranges(points: DataFrame, ranges: DataFrame, point: str, start: str, end: str) -> DataFrame:
    """Every row of `points` beside every row of `ranges` with start <= point <= end; NULLs match nothing.

    Column names of both sides must differ. Ranges of a measured size are
    broadcast; others are dealt by block, where adaptive execution may split the
    rows of a hot day."""
    cut = ranges.withColumn("_block", F.explode(blocks_of_range(F.col(start), F.col(end))))
    levels = sorted(r[0] for r in cut.select(F.shiftright("_block", 32).cast("int")).distinct().collect())  # LEVELS at most
    spread = points.filter(F.col(point).isNotNull()).withColumn("_block", F.explode(blocks_around(F.col(point), levels)))
    return spread.join(bounded(cut), "_block").drop("_block")
