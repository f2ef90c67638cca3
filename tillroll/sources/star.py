"""Basket lines and embeddings from the star-schema parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VISIT_COLUMNS = ("trip_type", "weekday", "visit_day")
PRODUCT_COLUMNS = ("department", "fineline")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def basket_lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per transaction line with ``visit_number``, ``line_number``, ``upc``,
    ``scan_count`` and the asked-for visit or product columns.

    A dimension is joined only when one of its columns is asked for: both joins are left
    joins on a unique key, so leaving one out changes no other column. Whether a side is
    broadcast is left to Spark, which checks its size.
    """
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("visit_number"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("upc"),
        (sign * F.ceil(F.col("l_quantity") / 10).cast("int")).alias("scan_count"),
    )
    if any(c in VISIT_COLUMNS for c in columns):
        lines = lines.join(visit_attributes(spark, sf_dir), "visit_number", "left")
    if any(c in PRODUCT_COLUMNS for c in columns):
        product = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("upc"),
            F.nullif(F.col("p_brand"), F.lit("Brand#13")).alias("department"),
            F.nullif(F.col("p_size"), F.lit(13)).alias("fineline"),
        )
        lines = lines.join(product, "upc", "left")
    return lines.select("visit_number", "line_number", "upc", "scan_count", *columns)


def line_count(spark: SparkSession, sf_dir: str) -> int:
    """Number of all transaction lines; no column is read."""
    return table(spark, sf_dir, "lineitem").count()


def visit_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per visit: label, weekday and day."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("visit_number"),
        F.col("o_orderpriority").alias("trip_type"),
        F.date_format("o_orderdate", "EEEE").alias("weekday"),
        F.to_date("o_orderdate").alias("visit_day"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id``, ``label`` and ``vec`` (array of double)."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("vec")
    )


def category_is_not(column: str, value: str) -> Column:
    """True unless the column equals ``value``; missing values pass."""
    return ~F.col(column).eqNullSafe(F.lit(value))
