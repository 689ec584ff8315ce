"""Session settings the engine relies on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every load and comparison assumes.  Naive vendor times are read as
# UTC (both directions), ANSI casts raise on junk text, AQE re-plans joins and
# splits skewed partitions at run time.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str = "local[8]", app: str = "dayload",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters pass their own conf."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.scheduler.mode", "FAIR")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**ENGINE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    """Apply the engine's SQL settings to an existing session."""
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)
    return spark


POOL = "spark.scheduler.pool"


@contextmanager
def own_pool(spark: SparkSession, name: str) -> Iterator[None]:
    """Run the block's jobs in a scheduler pool of that name, as its thread's property.

    With ``spark.scheduler.mode`` FAIR the pools share the cores, so a small
    table's jobs don't wait for a large one's tasks; else pools change nothing."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote session exposes no context
        sc = None
    if sc is None:
        yield
        return
    before = sc.getLocalProperty(POOL)
    sc.setLocalProperty(POOL, name)
    try:
        yield
    finally:
        sc.setLocalProperty(POOL, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name a folder every executor can reach.  Only a local
    session that has none gets one created and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote session exposes no context
        sc = None
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        root = tempfile.mkdtemp(prefix="dayload-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/dayload/{label}-{uuid.uuid4().hex[:12]}"
