"""Where jobs may write tables of their own: the shared folder the session names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """One folder per application below ``spark.checkpoint.dir``.

    Only a local session may go without that setting: it then gets a temporary folder, set as
    its checkpoint folder too. On a cluster a folder of one machine would not be seen by the
    others, so the setting is required there.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
        if not base:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            base = tempfile.mkdtemp(prefix="ordermill-")
            sc.setCheckpointDir(base)
        _roots[app] = f"{base.rstrip('/')}/ordermill-{app}-{uuid.uuid4().hex[:8]}"
    return _roots[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
