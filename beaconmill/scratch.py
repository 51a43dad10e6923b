"""A fresh folder for intermediate tables, where every executor can reach it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"
_own: dict[str, str] = {}


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``.

    A local session that does not name one gets one of its own, which is removed when the
    process ends. Elsewhere it must be set: a folder of one machine is invisible to the others.
    """
    shared = spark.conf.get(SETTING, None)
    if shared is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {SETTING} to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="beaconmill-")
            atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
        shared = _own[app]
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder that this session made, on whatever file system it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
