"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "classbench") -> SparkSession:
    """Local session used by tests, the bench and the entry point."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # files go with the frame
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CLASSBENCH_DRIVER_MEM", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediates.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder
    and is used as is.  Where it is unset, a
    cluster is an error and in local mode (tests) a folder is made under the system temporary directory and registered as the checkpoint
    directory, so ``DataFrame.checkpoint()`` works.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="classbench-ckpt-")
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder (never reused between calls)."""
    import uuid

    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df, name: str):
    """``df`` as a parquet table in the scratch folder: its size is known when a plan is made, and a lost executor costs a re-read."""
    path = new_scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_by_value(module) -> None:
    """Pickle a module's functions by value into Python tasks.

    Executor-side code (Arrow batch functions of the kernel map and the
    network) then needs only NumPy/pandas on the workers, not this package on
    their path.
    """
    from pyspark import cloudpickle

    try:
        cloudpickle.register_pickle_by_value(module)
    except ValueError:
        pass  # already registered


#: Bytes of feature vectors that one task of an iterative learner holds.
TASK_BYTES = 32 << 20


def tasks_for(n_rows: int, width: int) -> int:
    """Tasks for ``n_rows`` vectors of ``width`` doubles: by their bytes, so a pass over few small rows is one task."""
    return max(1, -(-n_rows * max(width, 1) * 8 // TASK_BYTES))
