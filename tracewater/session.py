"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Left to the cluster: master, memory, shuffle partitions. These only switch on
# what the operators rely on: run-time skew splitting and UTC timestamps.
RELIED_ON = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "tracewater", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**RELIED_ON, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the cluster's shared folder; whoever asks for it may delete it.

    The cluster names the folder in ``spark.checkpoint.dir``, or the driver has
    set it with ``SparkContext.setCheckpointDir``. Where neither is set, a
    temporary folder is made if the master is local, since one machine runs
    everything; it is recorded in the session, so that later calls reuse it.
    On a cluster a missing folder is an error: executors could not read what
    others wrote.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("tracewater.shared.dir", None)
    if not root:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = set_dir.get() if set_dir.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tracewater-")
        spark.conf.set("tracewater.shared.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
