"""Global positions and exact quantiles without one big task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.session import SMALL_ROWS, checkpoint

# Ranges that a pass over values tells apart.
RANGES = 1024
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def with_position(df: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the global order of ``order``.

    A range-partitioned sort numbers rows inside each partition; the offsets of the
    partitions (one small row each) turn that into a global position. The sorted rows are
    checkpointed, since the partition bounds are sampled and must not change afterwards.
    """
    ordered = checkpoint(df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("_part", F.shiftright("_row", _ROW_BITS))
    sizes = ordered.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        ordered.join(F.broadcast(offsets), "_part")  # one row per sort partition
        .withColumn(name, F.col("_offset") + F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_row", "_part", "_offset")
    )


def with_code(df: DataFrame, column: str, rows: int, name: str) -> DataFrame:
    """Dense 0-based rank of a unique column. ``rows`` is the counted size of ``df``."""
    if rows <= SMALL_ROWS:
        code = F.row_number().over(Window.orderBy(column)) - 1
        return df.withColumn(name, code.cast("int"))
    return with_position(df, column, name=name).withColumn(name, F.col(name).cast("int"))


def quantile(df: DataFrame, column: str, q: float, rows: int) -> float:
    """Exact quantile with linear interpolation over ``rows`` counted non-null values.

    Each pass counts the values in ``RANGES`` equal ranges and keeps the range that holds the wanted ranks, so a few
    passes find it at any size; a pass returns at most one row per range.
    """
    at = q * (rows - 1)
    low = int(at)
    high = min(low + 1, rows - 1)
    value = F.col(column).cast("double")
    # NaN is above all numbers, as in a sort.
    number = F.when(F.isnan(value), F.lit(float("inf"))).otherwise(value)
    values = df.select(number.alias("v")).where("v is not null")
    start, end = values.agg(F.min("v"), F.max("v")).first()
    before = 0  # values below the range
    while True:
        if start == end:
            return float(start)
        width = end / RANGES - start / RANGES
        if 0 < width < float("inf"):
            place = F.least(F.floor(F.col("v") / F.lit(width) - F.lit(start / width)), F.lit(RANGES - 1))
        else:  # no finer ranges: the least value and the others
            place = (F.col("v") > F.lit(start)).cast("long")
        inside = values.where(F.col("v").between(start, end)).groupBy(place.alias("r"))
        found = sorted(inside.agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most")).collect())
        for i, r in enumerate(found):
            if low < before + r.n:
                break
            before += r.n
        if high >= before + r.n:  # the two ranks lie on both sides of a range's end
            return float(r.most + (found[i + 1].least - r.most) * (at - low))
        if r.least == r.most:
            return float(r.least)
        start, end = r.least, r.most
