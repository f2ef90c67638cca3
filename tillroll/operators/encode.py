"""Category dictionaries: fitted on one frame, applied to any other."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.ranking import quantile, with_code
from tillroll.session import checkpoint, lookup_join

UNSEEN = -1


@dataclass(frozen=True)
class Dictionary:
    """Sorted distinct values with codes 0..n-1; a missing value gets the last code.

    ``table`` has ``value`` and ``code``. ``size`` counts the codes, that of the missing
    value included. Values not met in fitting get ``UNSEEN``.
    """

    table: DataFrame
    size: int
    null_code: int

    def encode(self, df: DataFrame, column: str, name: str) -> DataFrame:
        found = self.table.withColumnsRenamed({"value": column, "code": name})
        joined = lookup_join(df, found, [column], "left", self.size)
        code = F.when(F.col(column).isNull(), F.lit(self.null_code)).otherwise(F.coalesce(name, F.lit(UNSEEN)))
        return joined.withColumn(name, code).select(*df.columns, name)

    def decode(self, df: DataFrame, code: str, name: str) -> DataFrame:
        back = self.table.withColumnsRenamed({"code": code, "value": name})
        return lookup_join(df, back, [code], "left", self.size).select(*df.columns, name)

    def entries(self) -> DataFrame:
        """All (value, code) rows, the missing value included."""
        if self.null_code == UNSEEN:
            return self.table.select("value", "code")
        dtype = self.table.schema["value"].dataType
        spark = self.table.sparkSession
        missing = spark.range(1).select(F.lit(None).cast(dtype).alias("value"), F.lit(self.null_code).alias("code"))
        return self.table.select("value", "code").unionByName(missing)


def fit_dictionary(df: DataFrame, column: str) -> Dictionary:
    return dictionary_of(checkpoint(df.select(F.col(column).alias("value")).distinct()))


def dictionary_of(seen: DataFrame) -> Dictionary:
    """A dictionary from a table of distinct values in column ``value``."""
    n, rows = seen.agg(F.count("value"), F.count("*")).first()
    table = with_code(seen.filter(F.col("value").isNotNull()), "value", n, "code")
    return Dictionary(table, rows, n if rows > n else UNSEEN)


@dataclass(frozen=True)
class Vocabulary:
    """The frequent values of a column: ``value``, ``total`` and position ``idx``."""

    table: DataFrame
    size: int
    threshold: float

    def keep(self, df: DataFrame, column: str) -> DataFrame:
        """Only the rows whose value is in the vocabulary."""
        return lookup_join(df, self.table.select(F.col("value").alias(column)), [column], "left_semi", self.size)

    def index(self, df: DataFrame, column: str, name: str) -> DataFrame:
        """Add the position of the value; ``UNSEEN`` where it is not in the vocabulary."""
        table = self.table.select(F.col("value").alias(column), F.col("idx").alias(name))
        joined = lookup_join(df, table, [column], "left", self.size)
        return joined.withColumn(name, F.coalesce(name, F.lit(UNSEEN))).select(*df.columns, name)


def fit_vocabulary(df: DataFrame, column: str, total: Column, q: float) -> Vocabulary:
    """Values whose total lies strictly above the ``q`` quantile of all totals."""
    return vocabulary_of(checkpoint(df.groupBy(F.col(column).alias("value")).agg(total.alias("total"))), q)


def vocabulary_of(totals: DataFrame, q: float) -> Vocabulary:
    """A vocabulary from a table with one ``total`` per ``value``."""
    threshold = quantile(totals, "total", q, totals.count())
    kept = totals.filter(F.col("total") > F.lit(threshold))
    size = kept.count()
    return Vocabulary(with_code(kept, "value", size, "idx"), size, threshold)
