"""Where jobs keep their intermediate tables, checkpoints and stream state."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  A machine-local folder is
    used only when that is unset and the master is local, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="tidelog-")
    return _LOCAL_ROOTS[context.applicationId]


def new_dir(spark: SparkSession, purpose: str) -> str:
    """A folder name below the shared root that no other run uses."""
    return f"{shared_root(spark)}/tidelog/{purpose}-{uuid.uuid4().hex[:12]}"


def read_if_any(spark: SparkSession, path: str, schema: T.StructType, base: str | None = None) -> DataFrame:
    """A Parquet table that may not have been written yet; ``base`` is where its partition folders begin."""
    reader = spark.read.schema(schema)
    try:
        return (reader.option("basePath", base) if base else reader).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def side_by_side(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Run steps that do not read each other's results at the same time, so that the short jobs of one fill the gaps of another.

    All have ended when this returns or raises the first failure.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in running:
        step.result()
