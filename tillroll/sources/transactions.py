"""Transaction files: labelled and unlabelled lines, several rows per visit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

# Header names of the transaction files, with our column names.
FILE_COLUMNS = {
    "TripType": "trip_type",
    "VisitNumber": "visit_number",
    "Weekday": "weekday",
    "Upc": "upc",
    "ScanCount": "scan_count",
    "DepartmentDescription": "department",
    "FinelineNumber": "fineline",
}
_TYPES = {
    "TripType": IntegerType(),
    "VisitNumber": LongType(),
    "Weekday": StringType(),
    "Upc": LongType(),
    "ScanCount": IntegerType(),
    "DepartmentDescription": StringType(),
    "FinelineNumber": IntegerType(),
}


def file_schema(labelled: bool) -> StructType:
    names = [n for n in FILE_COLUMNS if labelled or n != "TripType"]
    return StructType([StructField(n, _TYPES[n], True) for n in names])


def read_transactions(spark: SparkSession, path: str, labelled: bool = True, mode: str = "PERMISSIVE") -> DataFrame:
    """Lines of a CSV file with header; the text ``NULL`` and empty fields are missing.

    A malformed number is missing too; with ``mode="FAILFAST"`` it is an error.
    """
    df = (
        spark.read.schema(file_schema(labelled))
        .option("header", True)
        .option("nullValue", "NULL")
        .option("enforceSchema", False)
        .option("mode", mode)
        .csv(path)
    )
    blank_as_null = [
        F.when(F.trim(c) == "", None).otherwise(F.col(c)).alias(c) if df.schema[c].dataType == StringType() else c
        for c in df.columns
    ]
    return df.select(*blank_as_null).withColumnsRenamed(FILE_COLUMNS)


def write_transactions(lines: DataFrame, path: str) -> None:
    """The same file layout, written from our column names."""
    back = {ours: theirs for theirs, ours in FILE_COLUMNS.items() if ours in lines.columns}
    lines.select(*back).withColumnsRenamed(back).write.option("header", True).option("nullValue", "NULL").csv(path)
