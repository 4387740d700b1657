"""Session helpers: the shared work folder and the settings tests and benchmarks use."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables.

    A cluster names a shared folder in ``spark.checkpoint.dir``; only a local-mode
    session without that setting gets a temporary folder of this machine.
    """
    shared = spark.conf.get(CHECKPOINT_SETTING, None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="crossmart-")
    return _local_folders[app]


def local_session(name: str = "crossmart", cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks (a cluster brings its own)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
