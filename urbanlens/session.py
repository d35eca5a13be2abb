"""Session construction and lineage control."""

from __future__ import annotations

import gc
import hashlib
import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC so timestamp arithmetic and epoch bounds are
# stable, ANSI so bad casts fail loudly unless a ``try_*`` function is used, AQE so
# shuffle partition counts, broadcast conversions and skewed joins are re-planned
# from runtime statistics instead of fixed numbers.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = "local[*]",
    app_name: str = "urbanlens",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's base settings.

    On a cluster pass ``master=None`` so the launcher's master is used, and size
    ``shuffle_partitions`` for the data (AQE coalesces small ones at runtime).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def package_archive() -> tuple[str, bytes]:
    """Name and content of a zip of this package; the name tells the content."""
    root = os.path.dirname(os.path.abspath(__file__))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                with open(path, "rb") as f:
                    z.writestr(zipfile.ZipInfo(os.path.relpath(path, os.path.dirname(root))), f.read())
    return f"urbanlens-{hashlib.sha256(out.getvalue()).hexdigest()[:16]}.zip", out.getvalue()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: from where the driver has it, and on a cluster from an
    archive in the shared checkpoint folder, which executors fetch like any dependency."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sc = spark.sparkContext
    paths = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        sc.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    if sc.master.startswith("local[") or sc.master == "local" or not spark.conf.get("spark.checkpoint.dir", None):
        return
    name, content = package_archive()
    if any(os.path.basename(x) == name for x in sc._python_includes):
        return
    hadoop = sc._jvm.org.apache.hadoop.fs.Path
    target, part = f"{checkpoint_dir(spark)}/{name}", f"{checkpoint_dir(spark)}/{name}.{uuid.uuid4().hex}"
    fs = hadoop(target).getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(hadoop(target)):
        stream = fs.create(hadoop(part), False)
        stream.write(bytearray(content))
        stream.close()
        fs.rename(hadoop(part), hadoop(target))
    sc.addPyFile(target)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there; it is never replaced.
    Only a local-mode session (tests) without the setting gets a scratch folder;
    on a cluster a machine-local folder would not survive executor loss, so the
    setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        configured = tempfile.mkdtemp(prefix="urbanlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint, whose blocks die with the
    executor). Use it where a long plan is reused by several actions.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def release(spark: SparkSession) -> None:
    """Let the executors delete shuffle files that nothing needs any more. They do so when the driver's references are
    collected as garbage, which a driver with much memory may not do before the disks are full."""
    gc.collect()  # frames that Python still holds in cycles
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet into the shared checkpoint folder and read back: for tables that are
    scanned several times by few of their columns, which a checkpoint's whole rows would make large."""
    path = f"{checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
