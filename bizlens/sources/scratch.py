"""Intermediate tables in the folder that driver and executors share.

Whatever is written inside ``scratch_space`` goes when the block ends; results still wanted are written
elsewhere before that.  Outside any space the files stay, since lazy results may read them at any time.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

_space: ContextVar[str | None] = ContextVar("bizlens_scratch_space", default=None)

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, what: str) -> str:
    """A fresh path in the open scratch space, else in ``spark.checkpoint.dir``, or, where that is unset, in the warehouse."""
    folder = _space.get() or spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    return f"{folder.rstrip('/')}/bizlens-{what}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts the lineage, survives lost executors, gives true sizes."""
    path = shared_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[str]:
    """A folder for all that is materialised in the block, removed at its end, failed or not.

    The folder is a database's location, so Spark itself removes it, on any file system.  Spaces nest: the
    inner one goes first.  A space belongs to the thread that opened it.
    """
    path, name = shared_path(spark, "space"), f"bizlens_space_{uuid.uuid4().hex}"
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{quoted}'")
    token = _space.set(path)
    try:
        yield path
    finally:
        _space.reset(token)
        spark.sql(f"DROP DATABASE {name} CASCADE")


def materialize_apart(spark: SparkSession, what: str, make: Callable[[], DataFrame]) -> DataFrame:
    """``make()`` written as Parquet and read back; what it materialised on its way is removed."""
    path = shared_path(spark, what)
    with scratch_space(spark):
        df = make()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the package to the executors' Python, once a session; Spark's own file service sends it."""
    sc = spark.sparkContext
    if getattr(sc, "_bizlens_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="bizlens-code-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._bizlens_shipped = True
