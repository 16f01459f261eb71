"""Session settings and stage materialisation."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "fieldloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; a cluster's own values win elsewhere.

    AQE sizes shuffle partitions, splits skewed ones and turns a join into a
    broadcast once a side has been measured below the threshold.  No operator
    hints a broadcast, so that measured threshold is the only way to one.
    Checkpoints are removed once nothing refers to them any more.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The shared folder that the session names; a local session without one gets a folder of its own.

    Off local mode a folder must be named.  A ``file:`` one is taken as any other: it may be
    mounted on all machines, and whoever names it says so.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get(CHECKPOINT_DIR, None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint a stage with several consumers in the shared folder the session names.

    A checkpoint outlives the executors that wrote it.
    """
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()
