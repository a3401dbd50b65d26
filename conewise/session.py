"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins and coalesces partitions at
# run time; skew-join splitting protects the identity joins where catch-all
# customers or a shared phone can hold a large share of the rows.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # target ~128 MB per post-shuffle partition when AQE splits skewed
    # partitions or rebalances; coalescing keeps at least the default
    # parallelism (parallelismFirst), so small stages still use every core
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # only takes effect when this call starts the JVM (local runs, tests)
    "spark.driver.memory": "16g",
}


def get_spark(
    app: str = "conewise",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is left to spark-submit unless given; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage and is taken from the
    session.  Only a local-mode session without the setting (tests, laptops)
    gets a fresh folder of its own, removed when the process ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it to shared storage "
                "(HDFS/S3/ABFS) before running conewise jobs on a cluster"
            )
        conf_dir = tempfile.mkdtemp(prefix="conewise-ckpt-", dir="/tmp")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_ARCHIVE = "conewise-workers.zip"


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, which may not have it on their path."""
    sc = spark.sparkContext
    if not any(os.path.basename(f) == _ARCHIVE for f in sc._python_includes):
        package = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp()  # Spark's driver serves the archive from here while the application runs
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        base = os.path.join(folder, _ARCHIVE.removesuffix(".zip"))
        sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package)))
