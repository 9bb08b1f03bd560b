"""Session construction and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "framesift", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are planned for.

    Settings already given by the cluster (``spark-submit --conf``) win: only
    what is passed in ``conf`` and the few semantics-bearing options are set.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # a re-run replaces only the partitions it produced (stale-row removal)
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    options.update(conf)
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folder: tempfile.TemporaryDirectory | None = None


def checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session; a private one only for local runs.

    A cluster names a shared folder in ``spark.checkpoint.dir``.  Falling back
    to a folder of one machine there would lose the data with that machine, so
    a cluster session without the setting is refused.
    """
    global _local_folder
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="framesift-")
    return _local_folder.name


_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, tidy: bool = False) -> DataFrame:
    """Store ``df`` in the checkpoint folder and continue from the stored table.

    The table is Parquet: later passes read only the columns they need, and a lost
    executor costs nothing that was stored.  With ``tidy`` Spark removes the shuffle files as soon as the
    table is stored, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/framesift-{uuid.uuid4().hex}"
    before = spark.conf.get(_TIDY, "false")
    if tidy:
        spark.conf.set(_TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.set(_TIDY, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` stored and that nothing will read any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


_READ_ONLY_NODES = re.compile(r"^[\s:+-]*(Project|Filter|Relation|LocalRelation|LogicalRDD|Range)\b")


def stored(df: DataFrame) -> DataFrame:
    """``df`` itself when it only reads, filters and projects; otherwise a stored copy.

    For operators that read their input more than once: a plain read may be repeated,
    a join, aggregate or window upstream should run once.
    """
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    plain = all(_READ_ONLY_NODES.match(line) for line in plan.splitlines() if line.strip())
    return df if plain else cut(df)
