"""Session helpers: recommended settings, object-store options, scratch folder, disk space given back."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar
from threading import Lock
from urllib.parse import urlparse

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}

# Whether Spark deletes the shuffle files of an execution when it ends. Without it they stay
# until the driver happens to collect the garbage that refers to them.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# The scratch folders named in the innermost open block of ``passing_scratch``.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing_scratch", default=None)

# Open blocks of ``freed_shuffles`` of each session, and the setting before the first of them.
_FREEING: dict[SparkSession, tuple[int, str | None]] = {}
_FREEING_LOCK = Lock()


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def object_store_options(
    endpoint: str,
    access_key: str,
    secret_key: str,
    region: str | None = None,
    tls: bool = False,
    path_style: bool = True,
) -> dict[str, str]:
    """Spark settings for an S3-compatible store reached through ``s3a://`` paths."""
    options = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
    }
    if region:
        options["spark.hadoop.fs.s3a.endpoint.region"] = region
    return options


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, visible to every executor.

    The shared folder is the one named by ``spark.checkpoint.dir``; a session without
    that setting uses its warehouse. On a cluster a folder of the driver's own machine,
    which is what Spark's default warehouse is, is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if urlparse(base).scheme in ("", "file") and not is_local(spark):
            raise RuntimeError(f"{base} is a folder of one machine: set spark.checkpoint.dir to a shared one")
        base = f"{base.rstrip('/')}/_scratch"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    passing = _PASSING.get()
    if passing is not None:
        passing.append(path)
    return path


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the scratch folders that are named in this block when it ends, however it ends.

    Yields the list of them, to discard some before the end. Nothing that is read after the
    block may depend on a folder named in it. Threads begun in the block are not part of it.
    """
    made: list[str] = []
    token = _PASSING.set(made)
    try:
        yield made
    finally:
        _PASSING.reset(token)
        discard(spark, made)


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete scratch folders; what cannot be deleted stays, for the owner of the scratch folder to expire."""
    for path in paths:
        with suppress(Exception):
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Have the shuffle files of what is run in this block deleted as soon as it has run.

    For writes, and for frames that are made in the block and run once. A frame that is run
    again makes its files again.
    """
    with _FREEING_LOCK:
        depth, before = _FREEING.get(spark) or (0, spark.conf.get(FREE_SHUFFLES, None))
        _FREEING[spark] = (depth + 1, before)
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _FREEING_LOCK:
            depth, before = _FREEING.pop(spark)
            if depth > 1:
                _FREEING[spark] = (depth - 1, before)
            elif before is None:
                spark.conf.unset(FREE_SHUFFLES)
            else:
                spark.conf.set(FREE_SHUFFLES, before)


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process."""
    return re.match(r"local(\[|$)", spark.sparkContext.master) is not None
