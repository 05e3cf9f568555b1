"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Zone in which the reference presents its marts (fixed value).
DISPLAY_TIMEZONE = "America/Argentina/Buenos_Aires"


def build_session(
    app: str = "tidemart",
    master: str | None = None,
    timezone: str = "UTC",
    **conf: str,
) -> SparkSession:
    """A session with the settings the operators rely on.

    ``conf`` adds or overrides settings; write dots as double underscores
    (``spark__sql__shuffle__partitions="8"``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": timezone,
        "spark.sql.ansi.enabled": "true",
        # Runtime re-planning: partition coalescing, broadcast by measured size,
        # and splitting of skewed join partitions.
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def session_date(spark: SparkSession) -> date:
    """Today, in the session's time zone, wherever the driver runs."""
    return spark.range(1).select(F.current_date()).first()[0]


def work_dir(spark: SparkSession) -> str:
    """A fresh folder every executor can reach.

    It lies under ``spark.checkpoint.dir``. Without that setting only a local
    master may fall back to a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="tidemart-")
    return f"{base.rstrip('/')}/tidemart/{uuid.uuid4().hex}"
