"""Joins of many rows with one row per key, where a key may be hot."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_table(spark: SparkSession, **columns: Sequence | pa.Array) -> DataFrame:
    """A table of what the driver holds. It comes as Arrow, so the planner knows its size and broadcasts it only if that is small."""
    return spark.createDataFrame(pa.table(columns))


def salted_join(facts: DataFrame, per_key: DataFrame, key: str, spread_by: Sequence[str], salts: int | None = None) -> DataFrame:
    """``facts`` with the columns of ``per_key``, a table with one row per key.

    AQE splits a skewed join only while nothing after it relies on its partitioning. Where an
    aggregation by the same key follows, the rows of each key are cut into ``salts`` parts here, by a
    hash of ``spread_by``, and each key's row is copied to every part. By default there are as many parts as shuffle
    partitions, so that one key can use all tasks.
    """
    salts = salts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "_salt"]).drop("_salt")
