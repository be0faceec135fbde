"""Session helpers: building a session, the shared checkpoint folder and
size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(master: str | None = None, app: str = "lodestar",
              shuffle_partitions: int | None = None,
              driver_memory: str = "16g") -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or max(8, cpus * 2)
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", driver_memory))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name a shared (HDFS/S3/...) folder and is
    only read here.  Only when it is unset (tests, local runs) do we make a
    private scratch folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d and not sc.getCheckpointDir() and not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not d:
        d = sc.getCheckpointDir() or tempfile.mkdtemp(prefix="lodestar-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # some deployments reject core confs at runtime
            pass
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    import uuid
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def bounded_broadcast(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows.

    The row count is checked with a bounded job (``limit(max_rows+1)``), so
    the check itself never scans more than needed.  Returns the (possibly
    hinted) frame and whether the hint was applied; beyond the bound the
    planner is left to pick a shuffle join.
    """
    n = df.limit(max_rows + 1).count()
    if n <= max_rows:
        return F.broadcast(df), True
    return df, False


#: Times a core's share of the rows that a partition may hold.
MOST_OF_SHARE = 2


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least one partition a core, none of them with most of the rows.

    A small table often comes as one file with one row group, which one task
    would read and work off alone; a large file of one row group is cut into
    many partitions, of which one has all rows.  So rows are counted by
    partition, which reads no texts.  An evenly cut table stays where it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df.rdd.getNumPartitions()
    if parts < cores:
        return df.repartition(cores)
    rows = df.select(F.spark_partition_id().alias("p")).groupBy("p").count()
    total, most = rows.agg(F.sum("count"), F.max("count")).first()
    if not total or most * cores <= MOST_OF_SHARE * total:
        return df
    return df.repartition(parts, F.xxhash64(*df.columns))  # by hash, as dealing in turn would sort the rows first


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``lodestar`` importable by Python workers (``addPyFile`` of a zip
    written once per SparkContext into the shared checkpoint folder)."""
    import io
    import zipfile
    from pathlib import Path

    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = Path(__file__).resolve().parent
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(pkg.rglob("*.py")):
            z.write(f, f"lodestar/{f.relative_to(pkg)}")
    root = checkpoint_root(spark).rstrip("/")
    if "://" in root and not root.startswith("file:"):
        # Shared storage: write through the JVM's Hadoop FileSystem.
        jvm = sc._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/lodestar-{key}.zip")
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        out = fs.create(path, True)
        out.write(bytearray(buf.getvalue()))
        out.close()
        target = path.toString()
    else:
        local = root[len("file:"):] if root.startswith("file:") else root
        os.makedirs(local, exist_ok=True)
        target = os.path.join(local, f"lodestar-{key}.zip")
        with open(target, "wb") as fh:
            fh.write(buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(key)
