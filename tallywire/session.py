"""Session construction, shared scratch space and size limits."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LIMIT_KEY = "spark.tallywire.groupRows"
_DEFAULT_LIMIT = 1_000_000


def build_session(master: str = "local[*]", app: str = "tallywire", **conf: str) -> SparkSession:
    """A session with the settings every operator here expects."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def group_row_limit(spark: SparkSession) -> int:
    """Rows that one task may hold for one group; larger groups are split."""
    return int(spark.conf.get(_LIMIT_KEY, str(_DEFAULT_LIMIT)))


def fits_one_task(df: DataFrame, limit: int | None = None) -> bool:
    """Whether all rows of ``df`` together stay under the group limit.

    On a Parquet scan this is answered from the footers.
    """
    bound = group_row_limit(df.sparkSession) if limit is None else limit
    return df.count() <= bound


def is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster. On one machine, and only there, a temporary folder stands in for it
    and is removed at the end."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if shared is None and current is None:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="tallywire-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    if current is None:
        spark.sparkContext.setCheckpointDir(shared)
    return shared or current


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/tallywire/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage through reliable storage, so lost executors cost nothing."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)
