"""Session-level helpers: where intermediate tables may be written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_root: str | None = None


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for one run, below the shared folder the cluster names.

    Executors must all see it, so only a local master may fall back to this machine's
    temporary folder.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        root = _fallback_root()
    return f"{root.rstrip('/')}/tidemark/{purpose}-{uuid.uuid4().hex}"


def _fallback_root() -> str:
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tidemark-")
    return _local_root
