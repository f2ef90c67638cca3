"""Session set-up, staging of intermediate tables and size-checked joins."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Largest table (rows) that may be broadcast or ordered in one task. Every use is
# behind a count of the actual table, with a shuffled way beyond the limit.
SMALL_ROWS = 200_000
# Basket lines that a task of a grouping by visit takes. Its tables need some 2 KB a line, all of its steps together.
LINES_PER_TASK = 400_000
# Copies of a lookup table made by a salted join, so a hot key meets many tasks.
SALTS = 32


def build_session(app: str = "tillroll", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for; ``conf`` overrides them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Python workers on the same machine answer at once; TCP adds some 40 ms to each small task.
        "spark.python.unix.domain.socket.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, so that Arrow functions can import it on any machine."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tillroll-"), "tillroll.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a temporary folder; a cluster has to name one,
    since executors must reach it after a loss.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tillroll-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def checkpoint(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage (reliable checkpoint, survives executor loss)."""
    staging_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: columnar, with known size.

    ``schema`` may restate the columns for the read, e.g. a struct as an ML vector.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def tasks_for(spark: SparkSession, lines: int) -> int:
    """Tasks that so many lines need: none takes over ``LINES_PER_TASK``."""
    return -(-lines // LINES_PER_TASK)


def dealt(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``df`` laid out by ``keys`` over ``tasks``, where these are more than can run at once; a grouping by ``keys`` then
    needs no other shuffle. Else left as it is, so that the grouping combines before its shuffle.

    The session's number of shuffle partitions does not matter: adaptive execution merges them by their stored size, down
    to as many as can run at once, whatever a line takes when it is grouped. A number that is asked for stays.
    """
    if tasks <= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(tasks, *keys)


def lookup_join(left: DataFrame, table: DataFrame, on: list[str], how: str, rows: int) -> DataFrame:
    """Join ``left`` with a lookup table of ``rows`` rows, unique on ``on``.

    Small tables are broadcast. Larger ones are replicated over salts, so that a key
    holding a large part of ``left`` is spread over ``SALTS`` tasks.
    """
    if rows <= SMALL_ROWS:
        return left.join(F.broadcast(table), on, how)
    others = [c for c in left.columns if c not in on]
    salt = F.pmod(F.xxhash64(*others) if others else F.monotonically_increasing_id(), F.lit(SALTS))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return left.withColumn("_salt", salt).join(copies, [*on, "_salt"], how).drop("_salt")
