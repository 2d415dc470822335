"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Datetimes in the source systems carry no zone; all arithmetic is done on
# TIMESTAMP_NTZ, and the session zone is pinned so that nothing else drifts.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A Bloom filter of the active customers' orders in the item scan: for item
    # tables from 1 MB on, from order rows of up to 8 GB (of which only the ids
    # are hashed), 8 MB of bits at most whatever the data.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "8GB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "67108864",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "clientele",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests, the bench and local runs.

    On a cluster, pass ``master=None`` and let spark-submit decide; the
    checkpoint folder then comes from the cluster's ``spark.checkpoint.dir``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for ``DataFrame.checkpoint``.

    The folder the cluster names in ``spark.checkpoint.dir``; where none is
    named, a folder in the warehouse, which executors share as well.  Never a
    machine-local scratch folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return sc.getCheckpointDir()
