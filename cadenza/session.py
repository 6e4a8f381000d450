"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# The number of shuffle partitions follows the input, see ``size_shuffles``.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Plays partitioned by (user, chunk) may join on more keys than these without a new shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
}

_own_dirs: dict[str, str] = {}


def build_session(app: str = "cadenza", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_RUNTIME = ["spark.sql.session.timeZone", "spark.sql.requireAllClusterKeysForCoPartition"]


def prepare(spark: SparkSession) -> SparkSession:
    """A session made elsewhere gets the settings results and plans rely on: dates, hours and
    partition folders are UTC."""
    for key in _RUNTIME:
        if spark.conf.get(key) != SETTINGS[key]:
            spark.conf.set(key, SETTINGS[key])
    return spark


BYTES_PER_PARTITION = 256 * 1024**2


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise the shuffle partitions to fit the input; AQE merges small ones but cannot add any.
    A larger number set by the user stays."""
    key = "spark.sql.shuffle.partitions"
    now = int(spark.conf.get(key))
    wanted = -(-input_bytes // BYTES_PER_PARTITION)
    if wanted > now:
        spark.conf.set(key, str(wanted))
    return max(wanted, now)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; only a local session may fall back to a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _own_dirs.setdefault(app, tempfile.mkdtemp(prefix="run-", dir="/tmp"))
