"""Session set-up and the checkpoint folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app_name: str = "comptoir", conf: dict[str, str] | None = None) -> SparkSession:
    """Session with UTC dates and adaptive execution; master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder in ``spark.checkpoint.dir``; only a local session may fall back to a new one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="comptoir-checkpoints-")
    context.setCheckpointDir(folder)
