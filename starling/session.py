"""Session defaults and the shared folder that materialised steps are written to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import SparkSession

# Runtime re-planning does the sizing: partitions are merged up to / split down to the advisory
# size, hot join partitions are split, and joins turn into broadcasts once a side is known small.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def shuffle_partitions(input_bytes: int, target_bytes: int = 128 << 20) -> int:
    """Shuffle partitions that hold about ``target_bytes`` each when all of the input is shuffled.

    Set it as ``spark.sql.shuffle.partitions``: it is where run-time merging starts from, so a
    number that is too high costs little and one that is too low spills.
    """
    return max(200, -(-input_bytes // target_bytes))


def build_session(app: str = "starling", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=None)
def _local_scratch(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="starling-")


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only for a local session without it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that every executor can reach")
    return _local_scratch(spark.sparkContext.applicationId)


_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    path = f"{scratch_root(spark)}/starling/{label}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path on whatever file system it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch paths taken inside are deleted at the end, by when their rows must be written."""
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            drop_path(spark, path)
