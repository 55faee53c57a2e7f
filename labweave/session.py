"""Session settings the plans rely on, and lineage cuts in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Semantics, not tuning: duplicate JSON keys and duplicate pair-list keys keep
# the last value, and timestamps print the same on every machine.
REQUIRED = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
}
# Layouts differ by row, so no query reads a fixed path of a stored body: cutting bodies up into columns
# on writing, and putting them together again on reading, would only cost.
WHOLE_BODIES = {"spark.sql.variant.inferShreddingSchema": "false"}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in (REQUIRED | WHOLE_BODIES).items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. A temporary one is made only for local masters."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="labweave-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def in_parts(c: Column) -> Column:
    """``c`` as it is, in a projection that is compiled as many small methods.

    Spark puts all projections between two exchanges into one method, and the JVM compiles none of more
    than 8,000 bytes of bytecode: it interprets it, row after row, at several times the cost. A higher-order
    function keeps its projection, with all columns beside it, out of such a stage and cuts it in two.
    """
    return F.transform(F.array(c), lambda x: x)[0]


_SCOPE: ContextVar[str] = ContextVar("scratch scope", default="")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/labweave/{_SCOPE.get()}{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What is landed inside is deleted at the end, when nothing reads it any more."""
    name = f"scope-{uuid.uuid4().hex}/"
    token = _SCOPE.set(name)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
            f"{shared_dir(spark)}/labweave/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checkpoint(df: DataFrame, name: str = "stage", *, by: str | None = None) -> DataFrame:
    """Cut the lineage of ``df`` by writing it to the shared folder as Parquet.

    Columnar, so later steps read only the columns they need (and, laid out ``by`` a column,
    only the values they filter for), and it outlives any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
