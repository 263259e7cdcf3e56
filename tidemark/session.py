"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    Only semantics are pinned (UTC, ANSI); sizes such as shuffle partitions are left to
    the cluster and to adaptive execution unless the caller passes them.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Feeds mix naive and zoned timestamps, so every plan is analysed with a UTC session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, on storage that the driver and all executors share.

    The cluster names the place in ``spark.checkpoint.dir``; where that is unset, it lies below the
    warehouse folder, which Spark itself resolves. Nothing is removed while a session may still read
    it: each session writes below ``scratch-<application id>``, which can be deleted once it has ended.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/scratch-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
