"""Session helpers: a local session for tests/bench and a shared scratch folder.

On a cluster the session is given; nothing here overrides its settings
except filling in a checkpoint folder when none is configured (tests).
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings we rely on for exact semantics, applied to sessions we build.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

PERFORMANCE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**SEMANTIC_CONF, **PERFORMANCE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only if it is unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed FS)
    folder and is used as is; without one the call fails rather than stage
    on machine-local disks.  Only in local mode with nothing configured
    (tests) a folder under the system temp dir is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not re.match(r"local(\[|$)", sc.master):  # not local-cluster
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: change sets are staged there")
        conf = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        atexit.register(shutil.rmtree, conf, ignore_errors=True)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def ship_code(spark: SparkSession) -> None:
    """Send this library's code to the executors, once for each Spark context (for the few steps that run Python there)."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="tidemark-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "tidemark"), "zip", root, "tidemark"))
    sc._tidemark_shipped = True


_SCRATCH: list[str] = []
#: Spark's setting that removes the shuffle files of a query at its end.
_END_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tidemark-{label}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Remove every scratch folder of this process.

    A lazy result still reads what was staged for it, so call this when
    results have been written or are no longer needed.
    """
    while _SCRATCH:
        drop_path(spark, _SCRATCH.pop())


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing
    upstream shuffles) and gives the optimizer exact file-size statistics.
    The write's shuffle files go when it has ended, not when the driver comes to collect garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_END_SHUFFLES, None)
    spark.conf.set(_END_SHUFFLES, "true")
    try:
        df.write.mode("error").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_END_SHUFFLES)
        else:
            spark.conf.set(_END_SHUFFLES, before)
    out = spark.read.parquet(path)
    out.staged_path = path
    return out


def unstage(*frames: DataFrame) -> None:
    """Remove what was staged as these frames (as ``stage`` returned them): all that is made of them has been staged itself."""
    for df in frames:
        path = df.staged_path
        if path in _SCRATCH:
            _SCRATCH.remove(path)
        drop_path(df.sparkSession, path)


def stage_measured(df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, str, dict, int]:
    """``stage`` plus metrics observed by the write (``rows`` always) and stored bytes."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()])
     .write.mode("error").parquet(path))
    return spark.read.schema(df.schema).parquet(path), path, seen.get, path_size_bytes(spark, path)


def path_size_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes stored under ``path`` (Hadoop FileSystem content summary)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a staging folder this library created (after its data is committed)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for tests that inspect files directly)."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["clear_scratch", "ship_code", "local_session", "ensure_checkpoint_dir", "scratch_path", "stage", "unstage",
           "stage_measured", "path_size_bytes", "drop_path", "local_path"]
