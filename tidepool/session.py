"""Session construction and the shared work folder.

Every job in this package takes a ``SparkSession`` and returns a DataFrame.  Jobs that
must write something first (versioned tables, stream layers, stream checkpoints, lineage
cuts) write it under ``work_dir(spark)``: a fresh sub-folder of the shared folder the
cluster names in ``spark.checkpoint.dir``.  Only a local session without that setting gets a
scratch folder of our own; on a cluster its absence is an error.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied to sessions built here.  Batch jobs run with AQE on (coalesce small
# shuffle partitions, split skewed join partitions, demote joins to broadcast at run time
# when the measured size allows it).  The session time zone is UTC so that event-time
# columns stored without a zone keep their wall-clock value.
BATCH_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tidepool",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench; on a cluster, use the session you are given."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**BATCH_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every job here relies on, applied to a session built elsewhere: UTC session
    time (event times are stored without a zone) and a checkpoint folder."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application (Spark distributes the file)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(here):  # not when we were imported from such a file ourselves
        to = os.path.join(tempfile.mkdtemp(prefix="tidepool-code-"), "tidepool")
        sc.addPyFile(shutil.make_archive(to, "zip", os.path.dirname(here), os.path.basename(here)))
    _shipped.add(sc.applicationId)


_scratch: dict[str, str] = {}  # application -> folder of a local session without the setting


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.  A scratch folder is made only where none is named and the
    session is a local one; on a cluster every executor would write to its own disk."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {sc.master} share")
        if sc.applicationId not in _scratch:
            _scratch[sc.applicationId] = tempfile.mkdtemp(prefix="tidepool-ckpt-")
        d = _scratch[sc.applicationId]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder for one job run."""
    path = "/".join([ensure_checkpoint_dir(spark).rstrip("/"), "tidepool", f"{name}-{uuid.uuid4().hex[:12]}"])
    ensure_folder(spark, path)
    return path


def folder(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path on whatever store it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Create a folder through its own file system (a file stream needs it)."""
    fs, p = folder(spark, path)
    fs.mkdirs(p)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
