"""Session helpers.

Library code never creates a session of its own: every operator takes
DataFrames and returns DataFrames.  These helpers are for tests, the bench
and command-line use.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the plans this library produces.  AQE re-plans
# joins from runtime sizes (shuffle -> broadcast when a side turns out small)
# and splits skewed join partitions; the local defaults here only size the
# shuffle for a single machine.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Fused rule chains generate processNext methods above the JVM's 8 KB
    # JIT limit; without this they run as interpreted bytecode.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lotline", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session (tests, bench), whose driver is its executor, gets a
    folder of its own where the setting is missing: ``fallback`` or a new
    scratch folder, removed when Python ends.  On a cluster a missing setting
    is an error, since executors would write where nobody else can read.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.sparkContext.getCheckpointDir()
        except Exception:  # no SparkContext access (Spark Connect)
            current = None
    if current:
        return current
    if not spark.conf.get("spark.master", "").startswith("local[") and spark.conf.get("spark.master", "") != "local":
        raise RuntimeError("spark.checkpoint.dir names no shared folder")
    path = fallback
    if not path:
        path = tempfile.mkdtemp(prefix="lotline-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:
        pass
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def cut_lineage(df):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    read it back.

    Cuts the lineage like a reliable ``checkpoint()`` (the files live in the
    folder named by ``spark.checkpoint.dir``, so they survive executor
    loss), but the written table is columnar: later reads prune columns and
    push filters down, and writing does not go through row serialization.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/lotline-tables/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
