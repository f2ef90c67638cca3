"""Each query against its SQL twin, on the smallest tables."""

import pytest

from tests.oracle import connect, duck_rows, spark_rows, types_of_duck, types_of_spark
from tillroll.plans import registry

SF = "/root/testdata/sf0.001"
registry.load()
# Fits on baskets and second-level runs repeat what the vector queries cover; they are
# compared by tests/compare.py.
# SQL has to spell out its columns; their number is that of the larger tables.
SPELLED_OUT = {"fineline_pivot", "visit_features_wide"}
LARGER = "/root/testdata/sf0.01"
SLOW = {"visit_class_probs", "level2_matrix", "visit_features_log", "varying_features", "blend_normalised"}


@pytest.mark.parametrize("name", [n for n in registry.SQL if n not in SLOW])
def test_matches_sql(spark, name):
    sf = LARGER if name in SPELLED_OUT else SF
    duck = connect(sf)
    df = registry.QUERIES[name](spark, sf)
    sql = registry.SQL[name]
    assert types_of_spark(df) == types_of_duck(duck, sql)
    columns, rows = spark_rows(df)
    wanted_columns, wanted = duck_rows(duck, sql)
    assert columns == wanted_columns
    assert len(rows) == len(wanted) > 0
    assert rows == wanted
