"""Session construction and shared scratch locations.

Intermediate tables, staging directories and streaming checkpoints must live on
storage every executor can reach. The cluster names that place in
``spark.checkpoint.dir``; it is read from the session. Only a local master may
go without (tests, laptops): then a local folder serves.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

_CONF_KEY = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    app_name: str = "shopstream",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session configured the way the jobs expect.

    UTC session zone (window boundaries and report days are UTC) and UI off.
    Master and shuffle partitions are set only when passed, so what
    ``spark-submit`` or the site's defaults say holds otherwise.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_root: str | None = None


def checkpoint_root(spark: SparkSession) -> str:
    """The session's shared scratch folder: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Without either, a local master gets a local folder (one for the process);
    on a cluster executors could not reach that, so it is an error there.
    """
    global _local_root
    root = spark.conf.get(_CONF_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CONF_KEY} to a folder that the driver and all executors share")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="shopstream-ckpt-")
        root = _local_root
    return root.rstrip("/")


_made: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint directory.

    Results are lazy and may read it later, so it stays until ``clean_scratch``
    or the end of the process.
    """
    path = f"{checkpoint_root(spark)}/shopstream/{name}-{uuid.uuid4().hex[:12]}"
    _made.append((spark, path))
    return path


def clean_scratch() -> None:
    """Delete every scratch path this process has handed out."""
    while _made:
        spark, path = _made.pop()
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(p, True)


def _at_exit() -> None:
    try:
        clean_scratch()
    except Exception:  # the JVM is gone already; what is left lies under spark.checkpoint.dir
        pass


atexit.register(_at_exit)
