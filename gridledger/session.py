"""SparkSession construction and shared-storage helpers.

Every job in the package assumes three session properties:

* ``spark.sql.session.timeZone = UTC`` -- day buckets and ``to_date`` on
  instants must not depend on the driver host's zone;
* ANSI mode on (the Spark 4 default) -- ingest paths use ``try_*`` functions
  so dirty rows are quarantined rather than failing the job;
* adaptive query execution on, with skew-join splitting, so a hot key in a
  sort-merge join is split at runtime instead of landing in one task.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the operators rely on.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what has been measured: no broadcast from plan-time size
    # estimates; AQE converts a join to broadcast once the completed shuffle
    # stage of a side has been measured under this bound.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "gridledger", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package's required settings.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset and let the submit configuration decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_sql_settings(spark)
    return spark


def apply_sql_settings(spark: SparkSession) -> None:
    """Pin the runtime SQL settings on a session someone else created."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled", "spark.sql.autoBroadcastJoinThreshold",
              "spark.sql.adaptive.autoBroadcastJoinThreshold",
              "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(k, SESSION_DEFAULTS[k])


def broadcast_if_small(df, max_rows: int = 200_000, known_rows: int | None = None):
    """``df`` with a broadcast hint if it has ``max_rows`` narrow rows at most; else as it is, for a shuffle join.

    For metadata frames (file lists, commit records): counting them is cheap, and without the hint the other side,
    which holds the data, would be shuffled before its size is known. ``known_rows`` is a bound that the caller has
    counted already.
    """
    from pyspark.sql import functions as F
    rows = df.limit(max_rows + 1).count() if known_rows is None else known_rows
    return F.broadcast(df) if rows <= max_rows else df


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for lineage cuts and scratch output.

    Reads ``spark.checkpoint.dir`` (or the SparkContext checkpoint directory).
    Only when neither is set *and* the master is local (local runs, tests) is a
    private directory created and registered; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 -- unset key raises in some versions
            conf_dir = None
    if not conf_dir:
        master = sc.master or ""
        if not re.fullmatch(r"local(\[.*\])?", master):      # local-cluster has executors of its own
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder every executor can reach "
                               "(a machine-local folder cannot hold checkpoints on a cluster)")
        conf_dir = tempfile.mkdtemp(prefix="gridledger-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique sub-path of the shared folder for one job's output."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{label}-{uuid.uuid4().hex}"


def materialize(df, spark: SparkSession | None = None):
    """Write ``df`` once to the shared checkpoint folder and cut its lineage.

    Used for small derived frames (file fingerprints, manifests) that several
    branches of one plan read: the expensive input (hashing every byte) runs
    once, and a lost executor re-reads the checkpoint instead of recomputing.
    """
    shared_dir(spark or df.sparkSession)
    return df.checkpoint(eager=True)
