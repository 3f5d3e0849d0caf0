"""Session helper.

Sets only what the operators rely on (AQE) and never overrides a value the
cluster already set; a fact's writer names its own overwrite mode. No operator depends on the
session time zone: every timestamp in the model is ``timestamp_ntz``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. On a new session they are defaults; on an
# existing (cluster) session only unset ones are filled in.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

def get_spark(master: str | None = None, app: str = "retail_marts", **conf: str) -> SparkSession:
    """Return the active session, or create one (tests, bench) with ``master``,
    the defaults above and ``conf``. An existing session keeps its settings;
    only unset defaults are added."""
    active = SparkSession.getActiveSession()
    if active is None:
        builder = SparkSession.builder.appName(app)
        if master:
            builder = builder.master(master)
        for k, v in {**_DEFAULTS, **conf}.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    else:
        spark = active
        for k, v in _DEFAULTS.items():
            if spark.conf.get(k, None) is None:
                try:
                    spark.conf.set(k, v)
                except Exception:  # a static setting of a running session
                    pass
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage; it is read from
    the session and never replaced. A folder already given to the
    SparkContext is kept. Only where the setting is unset and the master is
    local (tests, bench) a scratch folder is made; on a cluster that is an
    error, since a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...) for this cluster")
        path = tempfile.mkdtemp(prefix="retail-marts-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables, under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "tables", name)
