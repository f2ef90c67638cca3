"""CSV in and out."""

import glob

import pytest
from pyspark.sql import functions as F

from tillroll.sources.submission import read_template, template_columns, write_submission
from tillroll.sources.transactions import read_transactions


def test_read_missing_values(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text(
        '"TripType","VisitNumber","Weekday","Upc","ScanCount","DepartmentDescription","FinelineNumber"\n'
        '999,5,"Friday",40000000001,-1,"GARDEN",1000\n'
        '30,7,"Friday",,1,"NULL",\n'
        '30,7,"Friday",5000000002,2,"POTS, PANS",31\n'
    )
    rows = read_transactions(spark, str(path)).orderBy("visit_number", "scan_count").collect()
    assert tuple(rows[0]) == (999, 5, "Friday", 40000000001, -1, "GARDEN", 1000)
    assert (rows[1].upc, rows[1].department, rows[1].fineline) == (None, None, None)
    assert rows[2].department == "POTS, PANS"


def test_submission_follows_template(spark, tmp_path):
    template = tmp_path / "sample.csv"
    order = [9, 3, 7, 1]
    template.write_text("VisitNumber,T_3,T_5\n" + "".join(f"{v},0,0\n" for v in order))
    assert template_columns(spark, str(template)) == ["T_3", "T_5"]
    assert [r.visit_number for r in read_template(spark, str(template)).orderBy("row_order").collect()] == order
    long = spark.createDataFrame(
        [(v, c, v / 10 if c else 1 - v / 10) for v in (1, 3, 9) for c in (0, 1)], "visit_number bigint, class int, prob double"
    ).orderBy(F.rand(1))
    out = str(tmp_path / "out")
    assert write_submission(long, spark, str(template), out) == 1
    lines = [x for f in sorted(glob.glob(out + "/part-*.csv")) for x in open(f).read().splitlines()]
    header = "VisitNumber,T_3,T_5"
    assert lines[0] == header
    body = [x.split(",") for x in lines if x != header]
    assert [int(b[0]) for b in body] == order
    assert [float(b[2]) for b in body] == [0.9, 0.3, 0.0, 0.1]
    with pytest.raises(Exception, match="no scores for visit 7"):
        write_submission(long, spark, str(template), str(tmp_path / "strict"), strict=True)


def test_malformed_numbers(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("VisitNumber,Weekday,Upc,ScanCount,DepartmentDescription,FinelineNumber\n5,Friday,1,two,A,3\n")
    assert read_transactions(spark, str(path), labelled=False).first().scan_count is None
    with pytest.raises(Exception, match="FAILFAST"):
        read_transactions(spark, str(path), labelled=False, mode="FAILFAST").collect()
