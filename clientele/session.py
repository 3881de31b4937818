"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "clientele",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    ``master`` is only set when given, so on a cluster the launcher decides.
    ``spark.checkpoint.dir`` is left to the caller; see ensure_checkpoint_dir.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when none is configured.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local fallback is used for local
    masters only (tests, the bench).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not set in the runtime conf either
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="clientele-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder "
        "(HDFS/S3/ABFS) so frozen intermediate results survive executor loss")


def frozen_path(spark: SparkSession, tag: str = "frozen") -> str:
    """A fresh folder under the checkpoint directory for a written intermediate table."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/clientele-{tag}-{uuid.uuid4().hex}"


def freeze(df):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (later actions re-read the files instead of re-running the
    plan) and survives executor loss, like ``checkpoint()``, but in one write
    job and with a columnar, prunable read; its schema is given, so that no job
    opens a file to infer it.
    """
    spark = df.sparkSession
    path = frozen_path(spark)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*frames) -> None:
    """Delete the folders of frozen tables that are no longer read, and let Spark drop the shuffle files of
    frames that nothing refers to any more (its cleaner acts on the JVM's garbage collection)."""
    import gc
    for df in frames:
        spark = df.sparkSession
        jvm = spark._jvm
        for file in df.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            if folder.getName().startswith("clientele-"):
                folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
    if frames:
        spark = frames[0].sparkSession
        del frames, df
        gc.collect()
        spark._jvm.System.gc()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers wherever they run: its sources go to the executors as a zip
    file through Spark's own file distribution, once for each application."""
    import os
    import zipfile
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="clientele-sources-"), "clientele-sources.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in sorted(os.walk(home)):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    z.write(file, os.path.relpath(file, os.path.dirname(home)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
