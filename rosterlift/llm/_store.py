"""Where intermediate tables of the multi-pass operators are kept.

They are Parquet files in the folder that all executors share: ``spark.checkpoint.dir``, or, where that is unset (as in
tests), a folder inside ``spark.sql.warehouse.dir``. A lost executor costs a re-read, never a wrong or missing row.
"""

from __future__ import annotations

import gc
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_folder

BATCH_ROWS = 1000
_PACKAGE = Path(__file__).resolve().parent.parent
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def prepare(spark: SparkSession) -> None:
    """Before Python runs on the executors: bound the Arrow batches (texts can be long), and send this package along."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped[app] = folder = tempfile.TemporaryDirectory()  # the driver serves the file from here
        path = Path(folder.name, f"{_PACKAGE.name}-code.zip")
        with zipfile.ZipFile(path, "w") as code:
            for file in sorted(_PACKAGE.rglob("*.py")):
                code.write(file, file.relative_to(_PACKAGE.parent))
        spark.sparkContext.addPyFile(str(path))


class Scratch:
    """Tables of one run, each written once and read back."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = scratch_folder(spark)  # deleted by ``close``, or with all others by ``discard_durables``
        prepare(spark)

    def keep(self, df: DataFrame, name: str, few: bool = False) -> DataFrame:
        """Write ``df`` and read it back. ``few``: it is small for its number of partitions, so two tasks a core write it."""
        if few:
            df = df.coalesce(2 * self.spark.sparkContext.defaultParallelism)
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        """Delete all tables of the run, once its results are written."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let Spark delete the shuffle files of what is no longer referenced now, not when the driver next runs short of memory."""
        gc.collect()
        self.spark._jvm.System.gc()
