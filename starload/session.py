"""Session settings and the shared scratch location.

The library never creates or configures the session it works on: callers
pass theirs in. ``RECOMMENDED_CONF`` lists the settings the operators are
designed around (adaptive execution, so DISTINCT exchanges coalesce, skewed
join partitions split and rebalanced writes split hot partition values).
``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # size partitions by the advisory size, not by the number of cores
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "starload", extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, no ports beyond Spark's own)."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None under Spark Connect (no driver-side context)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def shared_dir(spark: SparkSession) -> str:
    """Root of the cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local-mode session without the setting
    gets a fresh temporary folder (as in tests); on a cluster an unset
    setting is an error, because a machine-local folder is not visible to
    other executors.
    """
    sc = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir")
        if not root and sc.getCheckpointDir():
            root = sc.getCheckpointDir().rsplit("/", 1)[0]
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        root = tempfile.mkdtemp(prefix="starload-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused path under the shared folder."""
    return f"{shared_dir(spark)}/starload/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> bool:
    """Deletes a scratch path through its Hadoop file system; False if the
    driver's JVM is out of reach, and the path stays."""
    sc = _context(spark)
    if sc is None or "/starload/" not in path:
        return False
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hpath, True))
