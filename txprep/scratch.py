"""Shared scratch space for files written by one step and read by another
(round-trip checks, stream checkpoints, materialised inputs).

Such files must live on storage every executor (and a replacement
executor) can read, so the location is taken from the session's
``spark.checkpoint.dir``: on a cluster that is the shared folder the
operator configured. Where it is unset, a session on this machine alone
(``local[..]``, as in tests) gets a temporary folder; on a cluster an error is
raised, since no folder of one machine would do.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            root = None
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local[") and \
                spark.conf.get("spark.master", "local") != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="txprep-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:
            pass
    return root.rstrip("/")


def _session_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/txprep/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder, in a folder of
    this application."""
    return f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Remove everything this application has put below the shared folder: call
    it when the results have been read or written elsewhere, since DataFrames
    that still read from there fail afterwards. Other applications' files stay.
    Returns whether there was anything to remove."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return bool(fs.delete(folder, True))
