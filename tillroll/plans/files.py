"""Queries that go through CSV files: transactions in and out, submissions by template."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tillroll.plans.registry import SQL, query
from tillroll.plans.sql import with_baskets
from tillroll.plans.vectors import N_CLASSES, votes
from tillroll.session import staging_root
from tillroll.sources.star import basket_lines
from tillroll.sources.submission import FILE_KEY, KEY, write_submission
from tillroll.sources.transactions import read_transactions, write_transactions


def _fresh_path(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


_LINES = "visit_number, weekday, upc, scan_count, department, fineline"


def _file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = basket_lines(spark, sf_dir, "trip_type", "weekday", "department", "fineline")
    return lines.withColumn("trip_type", F.substring("trip_type", 1, 1).cast("int")).drop("line_number")


@query("csv_round_trip", with_baskets(f"select cast(trip_type[1] as int) as trip_type, {_LINES} from b"))
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh_path(spark, "transactions")
    write_transactions(_file_lines(spark, sf_dir), path)
    return read_transactions(spark, path)


@query("csv_round_trip_unlabelled", with_baskets(f"select {_LINES} from b"))
def csv_round_trip_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh_path(spark, "transactions")
    write_transactions(_file_lines(spark, sf_dir).drop("trip_type"), path)
    return read_transactions(spark, path, labelled=False)


@query("submission_csv", SQL.get("submission_pivot"))
def submission_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-side votes written after a template file and read back."""
    test = votes(spark, sf_dir, [10]).filter(F.col("side") == "test")
    long = test.withColumnsRenamed({"label": "class", "qid": KEY})
    classes = [f"class_{i}" for i in range(N_CLASSES)]
    template, out = _fresh_path(spark, "template"), _fresh_path(spark, "submission")
    keys = long.select(F.col(KEY).alias(FILE_KEY)).distinct().orderBy(F.desc(FILE_KEY))
    keys.select(FILE_KEY, *[F.lit(0.0).alias(c) for c in classes]).write.option("header", True).csv(template)
    write_submission(long, spark, template, out)
    schema = StructType([StructField(FILE_KEY, LongType())] + [StructField(c, DoubleType()) for c in classes])
    written = spark.read.schema(schema).option("header", True).csv(out)
    return written.select(F.col(FILE_KEY).alias(KEY), *[F.round(c, 6).alias(c) for c in classes])
