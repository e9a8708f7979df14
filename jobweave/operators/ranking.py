"""Exact ranks, quantiles and running sums without one task seeing a whole group.

A window over one group sorts that group in a single task. Here the value axis is first cut into
buckets of about equal size. A running sum is then the total of the buckets below (a small
table) plus a window inside the bucket, so a group of any size spreads over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def default_buckets(df: DataFrame) -> int:
    """Enough buckets that each is the work of one ordinary task."""
    return max(64, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def cut_points(df: DataFrame, value: str, buckets: int) -> list[float]:
    """At most ``buckets - 1`` increasing cut points, about equally far apart in rank."""
    probabilities = [i / buckets for i in range(1, buckets)]
    found = df.select(F.col(value).cast("double").alias(value)).approxQuantile(
        value, probabilities, 0.5 / buckets
    )
    return sorted(set(found))


def add_bucket(df: DataFrame, value: str, cuts: Sequence[float], out: str) -> DataFrame:
    """Bucket number of each value; a larger value never gets a smaller bucket."""
    inner = list(cuts) or [0.0]
    splits = [float("-inf"), *inner, float("inf")]
    as_double = df.withColumn("_v", F.col(value).cast("double"))
    bucketed = Bucketizer(splits=splits, inputCol="_v", outputCol=out).transform(as_double)
    return bucketed.withColumn(out, F.col(out).cast("int")).drop("_v")


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def running_sums(
    df: DataFrame,
    value: str,
    measures: Sequence[str],
    by: Sequence[str] = (),
    buckets: int | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``<m>_before`` and ``<m>_total`` for each measure ``m``.

    ``<m>_before`` sums the measure over the rows of the same group that sort earlier. Rows
    should be pre-aggregated to one per (group, value), or ``order`` must name
    further columns that break ties.
    """
    parts = buckets or default_buckets(df)
    bucketed = add_bucket(df, value, cut_points(df, value, parts), "_bucket")
    keys = [*by, "_bucket"]
    sums = bucketed.groupBy(*keys).agg(*[F.sum(m).alias(f"_{m}_sum") for m in measures])
    # At most one row per group and bucket.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    below = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.coalesce(F.sum(f"_{m}_sum").over(below), F.lit(0)).alias(f"_{m}_off") for m in measures],
        *[F.sum(f"_{m}_sum").over(group).alias(f"{m}_total") for m in measures],
    )
    on = reduce(lambda a, b: a & b, [_same(F.col(k), F.col(f"_k_{k}")) for k in keys])
    inside = (
        Window.partitionBy(*keys)
        .orderBy(*(order or [value]))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = bucketed.join(offsets, on)
    out = joined.select(
        *df.columns,
        *[
            (F.coalesce(F.sum(m).over(inside), F.lit(0)) + F.col(f"_{m}_off")).alias(f"{m}_before")
            for m in measures
        ],
        *[F.col(f"{m}_total") for m in measures],
    )
    return out


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Exact interpolated quantiles per group: columns ``by``, ``n`` and ``q0``, ``q1``, ..."""
    counts = (
        df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    )
    ranked = running_sums(counts, value, ["n"], by, buckets)
    upto = F.col("n_before") + F.col("n")
    parts = []
    for i, p in enumerate(probabilities):
        place = (F.col("n_total") - 1) * F.lit(float(p))
        low, high = F.floor(place), F.ceil(place)
        parts += [
            F.min(F.when(upto > low, F.col(value).cast("double"))).alias(f"_lo{i}"),
            F.min(F.when(upto > high, F.col(value).cast("double"))).alias(f"_hi{i}"),
            F.max(place - low).alias(f"_w{i}"),
        ]
    picked = ranked.groupBy(*by).agg(F.max("n_total").alias("n"), *parts)
    return picked.select(
        *by,
        "n",
        *[
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_w{i}")).alias(f"q{i}")
            for i in range(len(probabilities))
        ],
    )


def order_cuts(values: DataFrame, column: str, parts: int) -> Column:
    """At most ``parts`` increasing values of a column of any orderable type, about equally far apart, as one array.

    They come from a sample chosen by a hash, some 16 per part, so their number does not grow with the rows.
    """
    rows = values.count()
    every = max(1, rows // (16 * parts))
    sample = sorted(r[0] for r in values.where(F.pmod(F.xxhash64(column), F.lit(every)) == 0).select(column).collect())
    kind = values.schema[column].dataType.simpleString()
    return F.array(*[F.lit(c) for c in sample[:: max(1, -(-len(sample) // parts))]]).cast(f"array<{kind}>")


def numbered_in_order(df: DataFrame, column: str, out: str, parts: int | None = None) -> DataFrame:
    """``column, out``: each distinct value that is not null, numbered from 0 in ascending order.

    Values are cut into stretches at sampled splitters; a window ranks inside a stretch, after the values of the stretches below. Any
    splitters give the exact numbers, good ones give even tasks, whatever the values have in common.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    cuts = order_cuts(values, column, parts or default_buckets(df))
    placed = values.withColumn("_stretch", F.size(F.filter(cuts, lambda c: c < F.col(column))))
    below = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)  # one row per stretch
    sizes = placed.groupBy("_stretch").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_stretch", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_stretch").orderBy(column)) - 1
    return placed.withColumn("_place", inside).join(offsets, "_stretch").select(column, (F.col("_before") + F.col("_place")).alias(out))
