"""A registry of queries by name, each with the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Registry(dict):
    def query(self, sql: str | None = None):
        def keep(f):
            self[f.__name__] = (f, sql)
            return f

        return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
