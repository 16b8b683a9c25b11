"""Session helpers: the runtime settings the engine relies on, and the shared
scratch folder.

Every setting here is a plain Spark SQL conf. ``ensure_conf`` only sets what
the engine needs for correct results; sizing settings (shuffle partitions,
broadcast threshold) are left to the cluster unless a builder is created here.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that change results, so every entry point applies them.
REQUIRED_CONF = {
    # Short/long CSV rows only report `_corrupt_record` with pruning off (T2).
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    # Partition folders month=01 must stay the string "01" when read back.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Rewriting one day must not drop the other days of the orders dataset.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Settings for runtime re-planning at scale: AQE coalesces small shuffle
# partitions, splits skewed ones and turns joins into broadcasts only after
# it has measured the real size of the small side.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# The JVM interprets methods of more than 8,000 bytes instead of compiling them.
# Row classification makes larger ones if a whole stage becomes one method;
# with this limit Spark runs such a stage as projections, which it splits into
# small methods (measured: 4.4 s -> 2.1 s for 600,000 rows).
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
METHOD_LIMIT_DEFAULT, METHOD_LIMIT_JVM = "65535", "8000"


def ensure_conf(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    if spark.conf.get(METHOD_LIMIT) == METHOD_LIMIT_DEFAULT:  # the caller's choice stays
        spark.conf.set(METHOD_LIMIT, METHOD_LIMIT_JVM)
    return spark


def build_session(master: str | None = None, app: str = "orderlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and scripts. On a cluster pass no master."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    conf.update(REQUIRED_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
    })
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_conf(spark)


@contextmanager
def conf_for(spark: SparkSession, **settings: str):
    """Runtime settings (``__`` for a dot) for the actions inside the block."""
    keys = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset and the master is local (tests) a private folder
    under the system temp dir is created and registered, so that
    ``DataFrame.checkpoint`` and our staged tables land in the same place; on
    a cluster an unset folder is an error.
    """
    global _LOCAL_ROOT
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - some deployments hide core confs
            root = None
    if not root:
        # getCheckpointDir() is "<configured>/<uuid>"; its parent is shared.
        cur = sc.getCheckpointDir()
        if cur:
            root = cur.rstrip("/").rsplit("/", 1)[0]
    if not root:
        if not re.match(r"local($|\[)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _LOCAL_ROOT is None:
            _LOCAL_ROOT = tempfile.mkdtemp(prefix="orderlake-ckpt-")
        root = _LOCAL_ROOT
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_LOCAL_ROOT: str | None = None


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    return "/".join([checkpoint_root(spark), "orderlake", *parts])


def unique_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read from there: it is computed
    once, lost executors cost nothing, and the planner knows its real size."""
    path = unique_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python can open a mounted folder."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def is_local(path: str) -> bool:
    return "://" not in path or path.startswith("file:")
