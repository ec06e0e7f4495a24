"""Session helpers for tests, the bench and the batch pipeline.

On a cluster the session is owned by the caller; these helpers only fill in
settings that are unset.  ``scratch_dir`` resolves the shared checkpoint
folder named by ``spark.checkpoint.dir``; a private temp folder is used only
when that setting is absent (local tests).
"""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid
import zipfile

from pyspark import SparkContext
from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; set a private one only when none is configured.

    ``spark.checkpoint.dir`` names the shared folder on a cluster; it is read,
    never overridden.  A temp folder is used only when it is absent and the master is local
    (tests); on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if path is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="ledgerlens-ckpt-"))
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> int:
    """Remove the intermediate tables that this session wrote, and tell how many.

    Spark gives every session a checkpoint folder of its own, in which only tables named by
    ``scratch_dir`` are touched.  Call it when no DataFrame built on them is needed any more;
    ``plans.datasets.clear`` also forgets the stages that are remembered by path.
    """
    base = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    tables = [f.getPath() for f in fs.listStatus(base)] if fs.exists(base) else []
    written = [t for t in tables if re.fullmatch(r".+-[0-9a-f]{12}", t.getName())]
    return sum(fs.delete(t, True) for t in written)


def release(sc: SparkContext) -> None:
    """Let go of the shuffle files behind a stored table now: Spark removes them only once the driver has collected its garbage."""
    gc.collect()
    sc._jvm.System.gc()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the executors run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerlens-"), "ledgerlens_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)  # the driver serves it; nothing is read from its folder
    _shipped.add(app)


def cluster_conf(input_bytes: int, advisory_mb: int = 256) -> dict[str, str]:
    """Suggested settings for a large cluster run (applied by whoever builds the session).

    * initial shuffle partitions sized so each holds ~2x the advisory size
      before AQE coalesces them (100 TB of input -> ~200k, capped at 100k);
    * scan splits of 512 MB; AQE skew-join splitting for hot accounts on the
      fact side of the feature joins; broadcast threshold kept modest (the
      code broadcasts derived tables itself, after a size check);
    * graceful decommission so shuffle and cached blocks migrate when an
      executor is lost or reclaimed.
    """
    parts = max(200, min(100_000, input_bytes // (2 * advisory_mb * 1024 * 1024)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_mb}m",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": "512m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.session.timeZone": "UTC",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.storage.decommission.rddBlocks.enabled": "true",
    }
