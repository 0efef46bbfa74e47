"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
START_CONF = {
    # Recording the call site of every column costs more than planning the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "bidscope",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the library's runtime settings; the cluster decides the rest."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**START_CONF, **RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Put the library's runtime settings on a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    ``spark.checkpoint.dir`` is used as given. Only a ``local`` session that names none gets a
    temporary folder; on a cluster a missing setting is an error, because a folder of one
    machine would be lost with that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named is None:
        named = context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
        named = tempfile.mkdtemp(prefix="bidscope-")
    elif not context.master.startswith("local") and _is_local(context, named):
        warnings.warn(f"spark.checkpoint.dir is {named}: every machine must have the same folder mounted there.", stacklevel=2)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def _is_local(context: SparkContext, path: str) -> bool:
    """Whether a path, by its scheme or the default one, is on the machine that reads it."""
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()).getUri().getScheme() == "file"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/bidscope/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, label: str = "staged") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has a cut lineage and a known size on disk, so the planner itself decides whether
    it is small enough to broadcast (``spark.sql.autoBroadcastJoinThreshold``) and otherwise
    plans a shuffled join with adaptive skew handling.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a frame that is read from fewer splits than there are cores.

    A frame with as many partitions as cores, as any large one has, is left as it is. Only for
    plain scans: to tell its partitions, a frame with joins would have to run their shuffles.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def one_row(df: DataFrame) -> Column:
    """The only row of ``df`` as a struct column, planned as a scalar subquery."""
    return df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row")).scalar()
