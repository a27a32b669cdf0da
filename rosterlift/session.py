"""Session settings and durable intermediate results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# forceOptimizeSkewedJoin: split a hot key even when that costs a later shuffle; otherwise a join followed by a
# grouping on the same key would keep the hot key in one task.
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


_stored: dict[str, DataFrame | None] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs rely on to an existing session."""
    for key, value in _RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(app: str = "rosterlift", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings; ``conf`` adds others.

    At large scale give ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` (or ``spark.sql.shuffle.partitions``)
    in ``conf``: exchanges begin with so many partitions, and adaptive execution merges small ones. About the shuffled
    bytes divided by 200 MB is right; the default of 200 partitions is for tables of up to some 40 GB.
    """
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**_RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables, shared by the driver and all executors: ``spark.checkpoint.dir``.

    Where that is unset, a local session takes a folder inside ``spark.sql.warehouse.dir``; a cluster has to name one.
    """
    settings = spark.sparkContext.getConf()
    shared = spark.conf.get("spark.checkpoint.dir", None) or settings.get("spark.checkpoint.dir")
    if shared:
        return shared
    if not (settings.get("spark.master") or "local").startswith("local") and not settings.get("spark.sql.warehouse.dir"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the scratch folder, now, and read it back: later jobs read stored rows, and no executor loss changes them.

    Stored rows keep their statistics and column pruning. ``discard_durables`` deletes them when the run is over.
    """
    path = f"{scratch_root(df.sparkSession)}/durable-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    _stored[path] = stored
    return stored


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for tables of this run; ``discard_durables`` deletes it."""
    path = f"{scratch_root(spark)}/run-{uuid.uuid4().hex}"
    _stored[path] = None
    return path


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def forget(stored: DataFrame) -> None:
    """Delete a relation of ``durable`` that nothing will read any more."""
    for path in [p for p, df in _stored.items() if df is stored]:
        del _stored[path]
        _delete(stored.sparkSession, path)


def discard_durables(spark: SparkSession) -> None:
    """Delete all that ``durable`` has stored. Call it once the results of the run are written."""
    while _stored:
        _delete(spark, _stored.popitem()[0])
