"""Per-visit summaries of basket lines.

All aggregates combine on the map side before they shuffle, and distinct counts shuffle on
(visit, value), so a visit holding a large part of all lines is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalar import FINELINE_SENTINEL, fineline_or_sentinel, guarded_ratio, units, upc_or_sentinel
from tillroll.session import SMALL_ROWS, stage

KEY = "visit_number"
HOT_LINES = 1_000_000  # a visit with more lines is joined by broadcast

# Names of the visit features in output order, and those put on a log scale.
BASIC_FEATURES = (
    "Min", "Max", "Mean", "Range", "Null", "Has_Neg", "Missing", "N_Fineline", "N_Upc", "N_Dep",
    "Sum", "Ratio_F_D", "Ratio_U_D", "mean_to_min", "max_to_mean",
)
LOGGED_FEATURES = (
    "Min", "Max", "Mean", "Range", "N_Fineline", "N_Upc", "N_Dep", "Sum", "Ratio_F_D", "Ratio_U_D",
    "mean_to_min", "max_to_mean",
)

# grouping_id over (visit_number, department, fineline, upc)
_BY_DEPARTMENT, _BY_FINELINE, _BY_UPC = 0b0011, 0b0101, 0b0110


def _flag(condition: Column) -> Column:
    return F.max(F.when(condition, 1).otherwise(0))


def department_spread(lines: DataFrame) -> DataFrame:
    """Min, max, mean and range over departments of the units per department, and their sum."""
    per_department = lines.groupBy(KEY, "department").agg(F.sum(units()).alias("u"))
    return per_department.groupBy(KEY).agg(*spread_of("u"))


def spread_of(u: str | Column) -> list[Column]:
    return [
        F.min(u).alias("Min"),
        F.max(u).alias("Max"),
        F.avg(u).alias("Mean"),
        (F.max(u) - F.min(u)).alias("Range"),
        F.sum(u).alias("Sum"),
    ]


def visit_flags(lines: DataFrame) -> DataFrame:
    """1/0 marks: a missing department, a return, a missing fineline."""
    return lines.groupBy(KEY).agg(
        _flag(F.col("department").isNull()).alias("Null"),
        _flag(F.col("scan_count") < 0).alias("Has_Neg"),
        _flag(fineline_or_sentinel() == FINELINE_SENTINEL).alias("Missing"),
    )


def _grains(lines: DataFrame) -> DataFrame:
    """Lines grouped three ways in one shuffle: by department, by fineline, by UPC."""
    filled = lines.select(
        KEY, "department", "scan_count", fineline_or_sentinel().alias("fineline"), upc_or_sentinel().alias("upc")
    )
    missing_fineline = F.when(F.col("fineline") == FINELINE_SENTINEL, 1).otherwise(0)
    prepared = filled.select(
        "*",
        units().alias("u"),
        F.when(F.col("scan_count") < 0, 1).otherwise(0).alias("neg"),
        missing_fineline.alias("nofine"),
    )
    return prepared.groupingSets(
        [[KEY, "department"], [KEY, "fineline"], [KEY, "upc"]], KEY, "department", "fineline", "upc"
    ).agg(
        F.grouping_id().alias("grain"),
        F.sum("u").alias("u"),
        F.max("neg").alias("neg"),
        F.max("nofine").alias("nofine"),
    )


def distinct_counts(lines: DataFrame) -> DataFrame:
    """Number of finelines, UPCs and departments; a missing value counts as one value."""
    grain = F.col("grain")
    return _grains(lines).groupBy(KEY).agg(
        F.count_if(grain == _BY_FINELINE).alias("N_Fineline"),
        F.count_if(grain == _BY_UPC).alias("N_Upc"),
        F.count_if(grain == _BY_DEPARTMENT).alias("N_Dep"),
    )


def distinct_counts_approx(lines: DataFrame, lg: int = 12) -> DataFrame:
    """As ``distinct_counts``, from one mergeable sketch per visit and kind: one shuffle by visit, of sketches and not of
    values. Exact (but for hash collisions) up to some hundred distinct values, then with a relative error of about
    ``1.04 / sqrt(2 ** lg)``."""
    filled = lines.select(KEY, "department", fineline_or_sentinel().alias("fineline"), upc_or_sentinel().alias("upc"))
    # A missing department is one value: each name gets a mark that no missing one has. (Sketches leave out empty text.)
    named = F.coalesce(F.concat(F.lit("="), "department"), F.lit("-"))
    kinds = {"N_Fineline": F.col("fineline"), "N_Upc": F.col("upc"), "N_Dep": named}
    return filled.groupBy(KEY).agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(c, F.lit(lg))).alias(n) for n, c in kinds.items()])


def with_ratios(visits: DataFrame) -> DataFrame:
    return visits.select(
        "*",
        (F.col("N_Fineline") / F.col("N_Dep")).alias("Ratio_F_D"),
        (F.col("N_Upc") / F.col("N_Dep")).alias("Ratio_U_D"),
        guarded_ratio(F.col("Mean"), F.col("Min")).alias("mean_to_min"),
        guarded_ratio(F.col("Max"), F.col("Mean")).alias("max_to_mean"),
    )


def visit_summary(lines: DataFrame) -> DataFrame:
    """All basic visit features: one scan, two shuffles."""
    grain = F.col("grain")
    by_department = grain == _BY_DEPARTMENT
    per_department = F.when(by_department, F.col("u"))
    summary = _grains(lines).groupBy(KEY).agg(
        *spread_of(per_department),
        F.max(F.when(by_department & F.col("department").isNull(), 1).otherwise(0)).alias("Null"),
        F.max("neg").alias("Has_Neg"),
        F.max("nofine").alias("Missing"),
        F.count_if(grain == _BY_FINELINE).alias("N_Fineline"),
        F.count_if(grain == _BY_UPC).alias("N_Upc"),
        F.count_if(by_department).alias("N_Dep"),
    )
    return with_ratios(summary).select(KEY, *BASIC_FEATURES)


def lines_with_totals(lines: DataFrame, hot_lines: int = HOT_LINES) -> DataFrame:
    """Each line with the totals of its visit.

    Totals are aggregated first and joined back, instead of a window over the visit. Visits
    with very many lines are few, so their totals are broadcast to their lines, which then
    need no shuffle; the other lines meet their totals in a shuffled join.
    """
    per_department = lines.groupBy(KEY, "department").agg(F.sum(units()).alias("u"), F.count("*").alias("n"))
    totals = stage(per_department.groupBy(KEY).agg(*spread_of("u"), F.sum("n").alias("_lines")))
    n_lines = totals.agg(F.sum("_lines")).first()[0] or 0
    # At most SMALL_ROWS visits can have more than this many lines.
    is_hot = F.col("_lines") > max(hot_lines, n_lines // SMALL_ROWS)
    hot = totals.filter(is_hot).drop("_lines")
    cold = totals.filter(~is_hot).drop("_lines")
    if hot.isEmpty():
        return lines.join(cold, KEY, "left")
    of_hot = lines.join(F.broadcast(hot), KEY)
    of_cold = lines.join(F.broadcast(hot.select(KEY)), KEY, "left_anti").join(cold, KEY, "left")
    return of_hot.unionByName(of_cold)


def distinct_visits(lines: DataFrame, *attributes: str) -> DataFrame:
    return lines.select(KEY, *attributes).distinct()


def first_line(lines: DataFrame, *order: str) -> DataFrame:
    """The first line of each visit in the given order (missing values first).

    A minimum over a struct combines on the map side, which a row number could not.
    """
    rest = [c for c in lines.columns if c != KEY and c not in order]
    row = F.min(F.struct(*order, *rest)).alias("row")
    return lines.groupBy(KEY).agg(row).select(KEY, "row.*")


def weekday_columns(visits: DataFrame, codes: int, code: str = "weekday_code", prefix: str = "Weekday_") -> DataFrame:
    """One 1/0 column per weekday code; an unseen weekday has 0 in all."""
    return visits.select(
        KEY, *[F.when(F.col(code) == i, 1).otherwise(0).alias(f"{prefix}{i}") for i in range(codes)]
    )
