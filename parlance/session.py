"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Spark's setting for the bytes of one batch that goes to a Python task, its default, and what whole texts get here.
_BATCH, _DEFAULT_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", 4 << 20


def local_session(cores: str = "8", app: str = "parlance") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; pick a folder only on a local master.

    A machine-local folder would not survive the loss of an executor, so a cluster
    that names no shared folder gets an error instead of a silent fallback.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
        _delete_on_exit(spark)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        _delete_on_exit(spark)
    else:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def _delete_on_exit(spark: SparkSession) -> None:
    """The folder that Spark made for this application's checkpoints goes when its JVM ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)


def freeze(df: DataFrame) -> DataFrame:
    """Compute a bounded artefact (a vocabulary, a model) once and read it back wherever it is used.

    Written to the shared checkpoint folder, so it outlives executors. What is frozen already is given back as it is.
    """
    if getattr(df, "_frozen", False):
        return df
    ensure_checkpoint_dir(df.sparkSession)
    frozen = df.checkpoint()
    frozen._frozen = True
    return frozen


def sent(df: DataFrame) -> DataFrame:
    """The table, whose batches will hold about ``BATCH_BYTES`` when a Python task reads them, and a row at least.

    A task keeps several forms of a batch of texts at once. A session that has a bound of its own keeps it.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH) == _DEFAULT_BATCH:
        conf.set(_BATCH, str(BATCH_BYTES))
    return df
