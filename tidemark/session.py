"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rebalanced writes split a hot bucket and glue small ones up to this size.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for.

    Shuffle partitions and split sizes depend on the cluster and stay with the caller
    (``spark.sql.shuffle.partitions`` is only the upper bound: AQE coalesces).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    Uses the folder named by ``spark.checkpoint.dir``; only a local session without that
    setting may fall back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    name = f"{label}-{uuid.uuid4().hex[:12]}"
    if shared:
        return f"{shared.rstrip('/')}/tidemark/{name}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return os.path.join(tempfile.mkdtemp(prefix="tidemark-"), name)
