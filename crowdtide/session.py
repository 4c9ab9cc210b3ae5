"""Session settings and lineage cutting."""

from __future__ import annotations

import logging
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # checkpoints go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # lets "row_number() <= cap" trim each map task before the shuffle
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def build_session(app_name: str = "crowdtide", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SESSION_CONF | {k.replace("__", "."): str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def changed_settings(spark: SparkSession, settings: dict):
    """Other settings for a while; what was set before comes back. Plans are made when their
    rows are asked for, so ask inside."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are rendered and cut into days in the session zone, which must be UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; where none is named, as in tests, a folder of
    the default file system."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            log.warning(
                "spark.checkpoint.dir is not set: /tmp/checkpoints of the default file system is used, "
                "which has to be one that all executors share"
            )
        context.setCheckpointDir(named or "/tmp/checkpoints")
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder once and read from there after.

    Used where several passes need the same expensive rows, so that a lost
    executor costs a re-read and not a re-run of the joins before it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_once(df: DataFrame, name: str) -> DataFrame:
    """The same for many narrow rows, as a compressed table: a checkpoint holds rows as they
    lie in memory, several times their size. The files stay until the folder is cleared."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of a batch of rows that goes to a Python worker.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """Batches for Python workers are cut by bytes: a worker holds its batch several times over,
    and rows may be long. The setting is the session's and stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).removesuffix("b")
    if not now.isdecimal() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    return spark


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores on a small input that comes in fewer pieces than there are cores.

    A file of one row group is one task, however slow the work on its rows. An
    input with enough pieces, which is any large one, is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, *keys)
    return df
