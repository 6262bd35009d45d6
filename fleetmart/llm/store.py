"""Tables written to the shared folder to cut lineage; a lost executor then costs no more than a re-read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.session import run_dir

#: Rows per Arrow batch of whole texts: bounds the memory of a Python worker.
TEXT_ROWS = "1000"
#: Spark's setting for the removal of a finished query's shuffle files.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def every(df: DataFrame) -> list[Column]:
    """All columns, whatever their names."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


class Workspace:
    """A fresh folder below ``spark.checkpoint.dir`` for the intermediate tables of one run."""

    def __init__(self, spark: SparkSession, name: str, tidy: bool = False):
        """``tidy``: the shuffle files of a table go once it is written. A lost table is computed anew all the same."""
        self.spark, self.path, self._n, self._tidy = spark, run_dir(spark, name), 0, tidy
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS)

    def save(self, df: DataFrame, name: str = "table", rows: int | None = None) -> DataFrame:
        """Writes a table and reads it back with the same schema. ``rows``: of an Arrow batch, for rows of numbers only."""
        self._n += 1
        path = f"{self.path}/{self._n}-{name}"
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS if rows is None else str(rows))
        if self._tidy:
            self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS)
            if self._tidy and before is None:
                self.spark.conf.unset(_CLEANUP)
            elif self._tidy:
                self.spark.conf.set(_CLEANUP, before)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._workspace_path = path
        return saved

    def drop(self, saved: DataFrame) -> None:
        """Removes a saved table that no later step reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(saved._workspace_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
