"""Tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arrivals_star.session import drop_scratch, scratch_path

#: Spark deletes a finished query's shuffle files while this is set.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Tables:
    """Tables written to the shared folder and read back, so that nothing above them runs again.

    A written table does not need the shuffle files of its plan any more: they go at once, so the
    disk in use is that of one step and not the sum of all. ``drop`` deletes the tables.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def store(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        path = scratch_path(self.spark, name)
        before = self.spark.conf.get(CLEAN_UP, None)
        self.spark.conf.set(CLEAN_UP, "true")
        try:
            df.write.parquet(path, compression=compression)
        finally:
            self.spark.conf.unset(CLEAN_UP) if before is None else self.spark.conf.set(CLEAN_UP, before)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_before_last(self) -> None:
        """Delete the table before the last one."""
        drop_scratch(self.spark, self.paths.pop(-2))

    def drop(self, keep: int) -> None:
        """Delete all tables but the last ``keep``."""
        drop_scratch(self.spark, *self.paths[:-keep])


__all__ = ["Tables", "CLEAN_UP"]
