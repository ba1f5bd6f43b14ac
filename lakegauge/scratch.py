"""Where intermediate tables go: the shared folder the cluster names, never a worker's own disk."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without one; it gets a temporary folder.
    """
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="lakegauge-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under :func:`scratch_root`; nothing is created."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
