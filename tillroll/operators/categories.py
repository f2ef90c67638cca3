"""Per-visit category measures: one aggregation for all categories, then a pivot.

The first aggregation is per (visit, category) and combines on the map side; what reaches
a visit afterwards is at most one row per known category.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.scalar import fineline_or_sentinel, guarded_ratio, units
from tillroll.operators.encode import Dictionary, Vocabulary, fit_vocabulary
from tillroll.operators.visits import KEY
from tillroll.session import dealt


def _scans() -> Column:
    return F.col("scan_count")


# Measures of a (visit, department) group that one aggregation gives.
MEASURES: dict[str, Callable[[], Column]] = {
    "D": lambda: F.sum(units()),
    "D1": lambda: F.sum(F.when(_scans() < 0, -_scans()).otherwise(0)),
    "D2": lambda: F.count_if(_scans() > 1),
    "D4": lambda: F.count_if(_scans() > 0),
    "D5": lambda: F.count_if(_scans() < 0),
}


def category_measure(lines: DataFrame, measure: str, column: str = "department", tasks: int = 0) -> DataFrame:
    """(visit, category, value) for one of ``MEASURES``, zeros included; over ``tasks``, if the session's own are fewer."""
    return dealt(lines, tasks, KEY, column).groupBy(KEY, column).agg(MEASURES[measure]().alias("value"))


def repeated_lines(lines: DataFrame, column: str = "department", tasks: int = 0) -> DataFrame:
    """(visit, category, value): lines whose fineline occurs more than once in the category."""
    named = lines.select(KEY, column, fineline_or_sentinel().alias("fineline"))
    cells = dealt(named, tasks, KEY, column, "fineline").groupBy(KEY, column, "fineline").agg(F.count("*").alias("n"))
    repeats = F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0))
    cells = dealt(cells, tasks, KEY)
    return cells.groupBy(KEY, column).agg(repeats.alias("value"))


def category_share(lines: DataFrame, column: str = "department") -> DataFrame:
    """(visit, category, value, share): units and their share of the units of the visit."""
    cells = category_measure(lines, "D", column)
    total = F.sum("value").over(Window.partitionBy(KEY))  # one row per category at most
    return cells.select(
        "*", total.alias("total"), guarded_ratio(F.col("value").cast("double"), total).alias("share")
    )


def category_presence(lines: DataFrame, column: str = "department") -> DataFrame:
    """(visit, category, value): 1 where the visit has any units at all, else 0."""
    return category_share(lines, column).select(KEY, column, F.when(F.col("total") > 0, 1).otherwise(0).alias("value"))


def spread(
    cells: DataFrame, dictionary: Dictionary, prefix: str, column: str = "department", value: str = "value", tasks: int = 0
) -> DataFrame:
    """One row per visit, one column per category code, 0 where the visit lacks it.

    Visits with only unseen categories stay, with zeros.
    """
    coded = dictionary.encode(cells, column, "code")
    return by_code(coded, "code", value, dictionary.size, prefix, tasks)


def by_code(cells: DataFrame, code: str, value: str, n: int, prefix: str, tasks: int = 0) -> DataFrame:
    """One row per visit with the sums of ``value`` by codes 0 to n - 1, in one grouping; 0 where the visit lacks a code."""
    sums = [F.coalesce(F.sum(F.when(F.col(code) == i, F.col(value))), F.lit(0)).alias(f"{prefix}_{i}") for i in range(n)]
    return dealt(cells.select(KEY, code, value), tasks, KEY).groupBy(KEY).agg(*sums)


def pair_columns(dummies: DataFrame, frequent: list[int], prefix: str = "D6") -> DataFrame:
    """Products of the presence columns of all pairs of frequent categories."""
    pairs = [(a, b) for i, a in enumerate(frequent) for b in frequent[i + 1 :]]
    return dummies.select(
        KEY, *[(F.col(f"{prefix}_{a}") * F.col(f"{prefix}_{b}")).alias(f"D_{a}_{b}") for a, b in pairs]
    )


def pair_presence(
    lines: DataFrame, dictionary: Dictionary, frequent: Vocabulary, column: str = "department"
) -> DataFrame:
    """The non-zero category pairs in long form: (visit, dept_a, dept_b, value = 1).

    The present frequent categories of a visit form one short array (at most the
    vocabulary), so the pairs come from array functions and not from a self-join.
    """
    present = category_presence(lines, column).filter(F.col("value") == 1)
    codes = frequent.keep(dictionary.encode(present, column, "code"), "code")
    sets = codes.groupBy(KEY).agg(F.array_sort(F.collect_set("code")).alias("codes"))
    later = F.transform(
        "codes",
        lambda a: F.transform(
            F.filter("codes", lambda b: b > a), lambda b: F.struct(a.alias("dept_a"), b.alias("dept_b"))
        ),
    )
    return sets.select(KEY, F.inline(F.flatten(later))).withColumn("value", F.lit(1))


def fineline_units(lines: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(visit, idx, value): units per frequent fineline, zeros included."""
    cells = lines.groupBy(KEY, fineline_or_sentinel().alias("fineline")).agg(F.sum(units()).alias("value"))
    indexed = vocabulary.index(cells, "fineline", "idx")
    return indexed.filter(F.col("idx") >= 0).select(KEY, "idx", "value")


def fineline_columns(lines: DataFrame, vocabulary: Vocabulary, tasks: int = 0) -> DataFrame:
    """``fineline_units`` as columns ``F_<idx>``, every visit kept."""
    named = lines.select(KEY, fineline_or_sentinel().alias("fineline"), units().alias("u"))
    cells = dealt(named, tasks, KEY, "fineline").groupBy(KEY, "fineline").agg(F.sum("u").alias("value"))
    return by_code(vocabulary.index(cells, "fineline", "idx"), "idx", "value", vocabulary.size, "F", tasks)


def department_vocabulary_codes(lines: DataFrame, dictionary: Dictionary, q: float) -> Vocabulary:
    """Departments, by code, whose number of lines lies strictly above the ``q`` quantile."""
    counts = lines.groupBy("department").agg(F.count("*").alias("n"))
    return fit_vocabulary(dictionary.encode(counts, "department", "code"), "code", F.sum("n"), q)
