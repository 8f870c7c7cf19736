"""Bounded parts of tables, the same for any order and partitioning of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = 1 << 30


def smallest_hashes(df: DataFrame, id_col: str, rows: int) -> DataFrame:
    """The ``rows`` rows whose ids have the smallest hashes; ids are distinct.

    Rows whose hash is clearly too large are left out first, so tasks send about twice ``rows`` rows in all to
    the last step, however many tasks there are.
    """
    n = df.count()
    if n > 2 * rows:
        # four standard deviations above the rows asked for, and never less than half as many again
        share = max(1.5 * rows, rows + 4 * rows**0.5 + 100) / n
        near = df.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(1)), F.lit(_SPACE)) < int(_SPACE * min(1.0, share)))
    else:
        near = df
    return near.orderBy(F.pmod(F.xxhash64(F.col(id_col), F.lit(1)), F.lit(_SPACE)), id_col).limit(rows)


def from_the_top(df: DataFrame, step: Column, most: int, *order: Column | str) -> DataFrame:
    """The rows of the highest steps, so many steps as hold at most ``most`` rows together.

    ``step`` is a whole number of few values.  Its histogram gives the last step, so no task sends candidates of
    its own to the driver.  Of the step at which ``most`` is passed the first rows by ``order`` fill the places
    left, so ties never empty the result; without an order all its rows are left out.
    """
    counts = df.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).where("step IS NOT NULL").collect()
    edge, beyond, total = None, None, 0
    for at, n in sorted(((r["step"], r["n"]) for r in counts), reverse=True):
        if total + n > most:
            beyond = at
            break
        edge, total = at, total + n
    whole = df.where(F.lit(False)) if edge is None else df.where(step >= edge)
    if beyond is None or not order or total == most:
        return whole
    return whole.unionByName(df.where(step == beyond).orderBy(*order).limit(most - total))
