import pytest

from tillroll.plans import registry
from tillroll.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    registry.load()
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("stage")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


LINES = (
    "visit_number bigint, line_number int, weekday string, upc bigint, scan_count int, department string, fineline int"
)


@pytest.fixture(scope="session")
def basket(spark):
    """Nulls, returns, an all-return visit (2), repeated finelines (3), a mixed visit (1)."""
    return spark.createDataFrame(
        [
            (1, 1, "Monday", 10, 2, "A", 1),
            (1, 2, "Monday", None, 1, None, None),
            (1, 3, "Monday", 11, -3, "B", 2),
            (2, 1, "Friday", 12, -1, "A", 1),
            (2, 2, "Friday", 12, -2, "A", None),
            (3, 1, "Friday", 13, 1, "A", 7),
            (3, 2, "Friday", 14, 1, "A", 7),
            (3, 3, "Friday", 15, 4, "A", 8),
            (3, 4, "Friday", 16, 1, "B", 7),
        ],
        LINES,
    )
