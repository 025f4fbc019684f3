"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every loomkit job relies on; cluster settings given by the
# launcher win because builder options never override an existing session.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "loomkit",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with loomkit's defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf.setdefault("spark.driver.memory", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to shared storage and it is used as
    is.  Only a local session without one gets a fresh folder; elsewhere a
    machine's own folder would not be seen by the other executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="loomkit-ckpt-")
        try:  # record it for later calls; some deployments refuse the change
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediates."""
    return os.path.join(checkpoint_dir(spark), name)


def materialize(df, name: str):
    """Cut lineage by writing ``df`` as parquet under the shared checkpoint
    folder and reading it back (survives executor loss; no recomputation)."""
    import uuid
    path = scratch_path(df.sparkSession, f"{name}/{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``loomkit`` importable in executor Python workers: zip the
    package once per SparkContext, copy the zip to the shared checkpoint
    folder and ``addPyFile`` it from there.  Needed by code that runs Python on executors
    (``mapInPandas``), whose pickled functions reference this package."""
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="loomkit-pyfiles-"), "loomkit.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("loomkit", os.path.relpath(full, pkg)))
    # executors fetch it from the shared checkpoint folder, not the driver's disk
    import uuid
    dst = scratch_path(spark, f"pyfiles/{uuid.uuid4().hex}/loomkit.zip")
    jvm = sc._jvm
    hp = jvm.org.apache.hadoop.fs.Path(dst)
    hp.getFileSystem(sc._jsc.hadoopConfiguration()).copyFromLocalFile(jvm.org.apache.hadoop.fs.Path(out), hp)
    sc.addPyFile(hp.toString())
    _SHIPPED.add(key)


def narrowed(df):
    """``df`` (straight out of a shuffle) coalesced to at most the cluster's
    default parallelism.  A cached or checkpointed relation keeps its
    partition count (AQE does not coalesce it).  The count is taken from
    ``spark.sql.shuffle.partitions`` because asking an adaptive plan for
    its partitions would execute it."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    cap = spark.sparkContext.defaultParallelism
    return df.coalesce(cap) if parts > cap else df
