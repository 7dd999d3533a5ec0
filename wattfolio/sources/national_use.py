"""National electricity use, two JSON shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattfolio import fixed


def _record(names: dict[str, str]) -> T.StructType:
    return T.StructType(
        [
            T.StructField(n, T.StringType() if n == "date" else T.DoubleType())
            for n in names
        ]
    )


NATIONAL_SCHEMA = T.StructType(
    [T.StructField("entries", T.ArrayType(_record(fixed.NATIONAL_USE_NAMES)))]
)
FINAL_SCHEMA = _record(fixed.FINAL_USE_NAMES)


def read_national_use(spark: SparkSession, path: str) -> DataFrame:
    """An object with an ``entries`` array. One task reads a whole file, so files must stay small."""
    raw = spark.read.schema(NATIONAL_SCHEMA).option("multiLine", True).json(path, mode="FAILFAST")
    return raw.select(F.explode("entries").alias("e")).select("e.*")


def read_final_use(spark: SparkSession, path: str) -> DataFrame:
    """A top-level array; each element is a row. One task reads a whole file, so files must stay small."""
    return spark.read.schema(FINAL_SCHEMA).option("multiLine", True).json(path, mode="FAILFAST")
