"""Session and configuration helpers.

Library code never creates its own cluster settings: it reads what the
session already has and only fills in values that are unset (tests, bench).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL confs the operators rely on.  `LAST_WIN` gives Python's dict
# semantics (later duplicate key wins) to map builders such as `map_concat`,
# `map_from_entries` and `transform_keys`.
RUNTIME_CONFS = {
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def ensure_runtime_confs(spark: SparkSession) -> None:
    for key, value in RUNTIME_CONFS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "listing_engine",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench; cluster jobs bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_runtime_confs(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, as the session names it.

    A folder already given to the context wins, then `spark.checkpoint.dir`.
    Where neither is set, a local master (tests, bench) gets a scratch folder
    of its own; a cluster is refused, because executors and driver would each
    write to their own disk and later reads would miss those files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="listing-engine-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_out(df):
    """The rows as Parquet in the shared checkpoint folder, read back: cut off
    from their plan, of a size Spark knows (it plans joins by it), and a reader
    takes only the columns it needs.  Row order and partitions are not kept."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
