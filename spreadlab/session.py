"""Session construction and the shared scratch folder.

Everything that has to outlive one stage (checkpoints, staged tables, stream
state) goes below the folder the cluster names in ``spark.checkpoint.dir``.  A
folder of this machine is used only when Spark runs in local mode and the
setting is absent, i.e. in tests.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_open_scopes: list[list[str]] = []


def local_session(cores: str = "*", app: str = "spreadlab", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", checkpoint_dir: str | None = None) -> SparkSession:
    """Session for tests and the local bench; clusters bring their own."""
    builder = SparkSession.builder
    if checkpoint_dir:
        builder = builder.config(CHECKPOINT_CONF, checkpoint_dir)
    spark = (
        builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared scratch folder of this session."""
    context = spark.sparkContext
    root = context.getConf().get(CHECKPOINT_CONF)
    if root:
        return root.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spreadlab-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the scratch root, grouped by application."""
    path = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    for scope in _open_scopes:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables made inside the block when it ends.

    For work that is finished by then; a DataFrame over such a table must not outlive the block.
    """
    made: list[str] = []
    _open_scopes.append(made)
    try:
        yield
    finally:
        _open_scopes.remove(made)
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in whatever store."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def checkpointed(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint (survives executor loss)."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint(eager=eager)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the scratch folder and read it back.

    Unlike a checkpoint the result keeps column pruning and filter pushdown, so
    this is the form for tables read more than once with different columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
