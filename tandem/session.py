"""Session helpers: a local session for tests/bench, shared scratch folders, table reads."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# The driver tables that registered queries read.
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: int | None = None, app: str = "tandem") -> SparkSession:
    """A local session sized for tests and the bench (UI off, AQE on)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("TANDEM_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only when it is unset and the master is local (tests) is a fresh local folder created;
    on a cluster an unset folder is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        sc = None
    cur = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        cur = tempfile.mkdtemp(prefix="tandem-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", cur)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(cur)
    return (sc.getCheckpointDir() if sc is not None else None) or cur


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared checkpoint folder for written tables/files."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tandem-{label}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once a session: their Python workers may not have its path."""
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        return
    if getattr(sc, "_tandem_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tandem-package-"), "tandem_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tandem", os.path.relpath(full, package)))
    sc.addPyFile(path)
    sc._tandem_shipped = True


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that has fewer partitions than the session has cores.

    A small table stored as one row group is read by one task, and the per-row work
    after it (cleaning, line splitting, word explosion) would run single-threaded. At
    cluster scale a scan has far more splits than cores and this is a no-op.
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores:
            return df.repartition(cores)
    except Exception:  # no local SparkContext (Spark Connect): leave the scan as it is
        pass
    return df


def dealt(df: DataFrame) -> DataFrame:
    """Deal a small derived table evenly over the session's shuffle partitions (no job runs)."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


# Tables whose rows carry whole texts: heavy per-row work (cleaning, splitting,
# exploding) follows their scans, so a single-split scan is spread over the cores.
TEXT_TABLES = frozenset({"documents", "conversations", "pages", "benchmark"})


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df
