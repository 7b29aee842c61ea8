"""Session helpers: a tuned SparkSession and the shared scratch folder.

On a cluster the scratch folder is the one named by ``spark.checkpoint.dir``
(a shared file system). A folder of our own is only set when that setting is
missing, which happens in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at run time (broadcast only
# when the measured side is under ``autoBroadcastJoinThreshold``) and splits
# skewed join partitions, which is how hot users/items are handled in joins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.compression.codec": "zstd",
    # checkpoint files of DataFrames that are no longer referenced are removed by the context cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "duotower", shuffle_partitions: int | None = None,
                driver_memory: str | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``duotower`` importable in the Python workers (once per SparkContext).

    The package is zipped in memory, written to the shared scratch folder
    through the Hadoop FileSystem API, and added with ``addPyFile`` (as
    ``--py-files`` would); every executor fetches it from there.
    """
    sc = spark.sparkContext
    if getattr(sc, "_duotower_shipped", False):
        return
    import hashlib
    import io
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in sorted(os.walk(pkg)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    data = buf.getvalue()
    target = scratch_path(spark, "pkg", hashlib.sha1(data).hexdigest()[:12], "duotower.zip")
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        out = fs.create(path, True)
        out.write(bytearray(data))
        out.close()
    sc.addPyFile(target)
    sc._duotower_shipped = True


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    Reads ``spark.checkpoint.dir`` from the session. It must be set on a cluster; on a
    local master (tests) a fresh folder is created and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="duotower-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A unique sub-folder of the shared scratch root."""
    return os.path.join(scratch_root(spark), "duotower", *parts)


def new_run_id() -> str:
    return uuid.uuid4().hex[:16]


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
