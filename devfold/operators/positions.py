"""Row numbers in a global order, without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from devfold.session import materialize

ROW_BITS = 33  # a row's id is its partition's number and, in this many bits, its place there


def numbered(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """``df`` with its place, from 1, in the ascending order of some columns, nulls first; ties in any order.

    Rows are dealt by range and sorted where they are; the places of a partition start behind the row
    counts of those before it, one number for each partition. Rows with equal keys may be
    any share of all: the place of a row in the written input decides among them, so a large group is
    split. That input and the sorted rows are written, as a retried task must find the same places again.
    """
    at, place = _free(df, "at"), _free(df, "place")
    rows = materialize(df.withColumn(at, F.monotonically_increasing_id()))
    dealt = rows.repartitionByRange(*order, at).sortWithinPartitions(*order, at).drop(at)
    dealt = materialize(dealt.withColumn(place, F.monotonically_increasing_id()))
    part = F.shiftright(place, ROW_BITS)
    # one row for each partition of the sort
    sizes = dealt.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.col(place).bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    joined = dealt.join(F.broadcast(starts), part == starts["_part"])
    return joined.withColumn(name, F.col("_start") + inside).drop(place, "_part", "_start")


def _free(df: DataFrame, name: str) -> str:
    """A column name that ``df`` has not got."""
    while name in df.columns:
        name = f"_{name}"
    return name
