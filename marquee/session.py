"""Session construction and shared-folder helpers.

Everything here is plain Spark configuration.  The settings that matter at
scale are AQE (runtime partition coalescing, skew-join splitting and
broadcast conversion based on *measured* sizes), a UTC session zone (the
month buckets and epoch conversions depend on it) and the RocksDB state
store for the streaming operators.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "marquee",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    # Session-level settings also apply when the session already existed.
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(k, settings[k])
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (distributed) folder and is
    only read.  Where it is unset -- local runs and tests -- a fresh
    scratch folder is created and recorded in the session.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="marquee-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never a
    machine-local temp folder), unique per call."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written down once in the shared folder, for plans that read it
    more than once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apply_query_defaults(spark: SparkSession) -> None:
    """Settings every registered query relies on, applied to a session
    built elsewhere: UTC session zone (epoch and month conversions), the
    RocksDB state store (keyed streaming state), AQE with skew splitting,
    and a checkpoint folder (kept if the session names one)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(k, "true")
    key = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in (spark.conf.get(key, "") or ""):
        spark.conf.set(key, DEFAULT_CONF[key])
    checkpoint_dir(spark)
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Make this package's code usable in every Python worker, whatever the
    working directory or path of the calling process.

    ``mapInPandas`` functions and the stateful processors are defined in
    this package; PySpark's cloudpickle is told to serialise the package's
    functions and classes by value, so neither executor workers nor the
    driver-side streaming runner need to import it.
    """
    from pyspark import cloudpickle

    import marquee
    cloudpickle.register_pickle_by_value(marquee)
