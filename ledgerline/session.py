"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "ledgerline", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on. Sizing is left to the cluster unless given in `settings`."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder of the cluster (`spark.checkpoint.dir`).

    Only a local session without that setting falls back to the temporary folder of the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/ledgerline-{purpose}-{uuid.uuid4().hex}"
