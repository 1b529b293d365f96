"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library is tuned for.

    Adaptive execution picks join strategies from run-time sizes, coalesces small
    shuffle partitions and splits skewed join partitions, so shuffle partition
    counts can be set high on a cluster without hurting small inputs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
        # Recording the Python line of every column call costs more than planning does.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Local sessions without that setting get a temporary folder. On a cluster a
    machine-local folder would be lost with its executor, so it is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        # Executors of a local-cluster have folders of their own, like those of any cluster.
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
