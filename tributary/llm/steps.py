"""Tables between the steps of an operator, in the shared folder, given back when their reader is done."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from tributary.session import scratch_path


class Steps:
    """Writes steps and drops them. A step that is written needs nothing before it any more, so a lost
    executor only re-reads files; what came before may go."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._paths: dict[str, str] = {}

    def keep(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        schema, path = df.schema, scratch_path(self._spark, name)
        df.write.parquet(path, compression=compression)
        self._paths[name] = path
        return self._spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete steps that nothing reads any more, and let Spark free the shuffle files of jobs that are
        over: it does so when the driver collects its garbage, which first has to let go of them here."""
        context = self._spark.sparkContext
        for name in names:
            path = context._jvm.org.apache.hadoop.fs.Path(self._paths.pop(name))
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        context._jvm.System.gc()
