"""A SparkSession with the settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "quillspark", master: str | None = None, **conf: str) -> SparkSession:
    """Existing settings win over these defaults only where the caller gives them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in {**defaults, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
