"""Session helpers: a local session for tests and the bench, and the shared
scratch folder every job uses for lineage cuts and round-trip files."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants; the driver's session may lack them,
# so nothing in the operators depends on them for correctness.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on measured sizes: no broadcast from static (file-size)
    # estimates; AQE converts a join once the small side's real size is known.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "precinct",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """A ``local[cores]`` session with AQE on and the UI off (tests, bench)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(total_cores: int, input_bytes: int | None = None) -> dict[str, str]:
    """Recommended settings for a cluster run (apply to the session builder).

    * ``maxPartitionBytes`` 512 MiB: four times fewer scan tasks than the
      default on a 100 TB fact; every report starts with scan + partial
      aggregation, whose map output is tiny per task.
    * shuffle partitions: 3 x cores as the AQE starting point; AQE coalesces
      the small post-aggregation shuffles and splits skewed join partitions.
      With ``input_bytes`` the count is also at least input / 1 GiB, so a
      row-level shuffle (a non-broadcast join) stays near 1 GiB per task.
    """
    parts = 3 * total_cores
    if input_bytes:
        parts = max(parts, input_bytes // (1 << 30))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
    }


def session(app_name: str, executors: int | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Session for ``spark-submit`` runs: master and resources come from the
    submit command; ``executors`` sets ``spark.executor.instances``."""
    builder = SparkSession.builder.appName(app_name)
    if executors is not None:
        builder = builder.config("spark.executor.instances", str(executors))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is read, never
    replaced; else a folder given by ``setCheckpointDir`` is taken. If both are
    missing there, this fails rather than fall back to a machine-local folder.
    Only in local mode is a folder below the session's warehouse used.
    """
    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root and given.isDefined():
        root = given.get()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set("spark.checkpoint.dir", root)
    if given.isEmpty():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path below the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"


__all__ = ["local_session", "session", "cluster_conf", "checkpoint_root", "scratch_path"]
