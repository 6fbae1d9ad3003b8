"""Session settings for stand-alone runs, and the folder for intermediate tables."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library is tuned for. Shuffle partition counts are left to the cluster: AQE
# merges small ones, so the number only has to be large enough for the biggest shuffle.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A shuffled join hashes instead of sorting where every measured partition is this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "millrace", **conf) -> SparkSession:
    """Build a session with :data:`DEFAULTS`; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a session of one local process without that setting gets a temporary folder of this
    machine, which goes when the process ends; anywhere else a missing setting is an error, since
    executors could not read what others wrote.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_root()


@functools.cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below :func:`shared_root` that no earlier call has handed out."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
