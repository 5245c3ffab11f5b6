"""Where intermediate tables live: the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, reachable by every executor.

    Only a ``local`` master may run without the setting; it gets one temporary
    folder per application.  On a cluster a missing setting is an error, because
    a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get(_SETTING, None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
        app = spark.conf.get("spark.app.id", "local")
        root = _local_roots.setdefault(app, "") or tempfile.mkdtemp(prefix="freight-")
        _local_roots[app] = root
    return f"{root.rstrip('/')}/freight/{label}-{uuid.uuid4().hex}"
