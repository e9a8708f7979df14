"""Train/test splits, class weights and the checks made before a fit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobweave.functions.rules import hash_bits, hash_percent
from jobweave.operators.ranking import default_buckets


def hash_split(df: DataFrame, id_col: str, train_percent: int = 80, out: str = "is_train") -> DataFrame:
    """Seeded random split. It depends only on the id, so a retried task repeats it."""
    return df.withColumn(out, hash_percent(F.col(id_col)) < train_percent)


def stratified_split(
    df: DataFrame, label: str, id_col: str, train_fraction: float = 0.8, out: str = "is_train"
) -> DataFrame:
    """Exact split: of ``n`` rows of a class the rounded share goes to train.

    Rows are ranked by hash inside their class. The hash is uniform, so cutting its range evenly
    gives small equal buckets for the window, however large a class is.
    """
    parts = default_buckets(df)
    keyed = df.withColumn("_hash", hash_bits(F.col(id_col))).withColumn(
        "_bucket", F.floor(F.col("_hash") / F.lit(float(1 << 60)) * parts).cast("int")
    )
    sizes = keyed.groupBy(label, "_bucket").agg(F.count("*").alias("_n"))
    klass = Window.partitionBy(label)
    below = klass.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(label).alias("_l"),
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_before"),
        F.floor(F.sum("_n").over(klass) * F.lit(train_fraction) + 0.5).alias("_quota"),
    )
    rank = F.row_number().over(Window.partitionBy(label, "_bucket").orderBy("_hash", id_col))
    joined = keyed.join(
        offsets, F.col(label).eqNullSafe(F.col("_l")) & (F.col("_bucket") == F.col("_b"))
    )
    return joined.withColumn(out, F.col("_before") + rank <= F.col("_quota")).select(*df.columns, out)


def half_split(df: DataFrame, id_col: str, out: str = "is_first_half") -> DataFrame:
    """The first half of the rows in id order, for ids of any orderable type; ``id_col`` must be unique.

    Cut points are ids themselves, taken from a hash-chosen sample; any cut points give the exact middle, as the rows
    between two of them are counted and only one stretch is ranked. Rows without an id are in no half.
    """
    parts = default_buckets(df)
    ids = df.select(id_col).where(F.col(id_col).isNotNull())
    rows = ids.count()
    half = rows // 2
    if not half:
        return df.withColumn(out, F.lit(False))
    every = max(1, rows // (16 * parts))
    sample = sorted(r[0] for r in ids.where(F.pmod(F.xxhash64(id_col), F.lit(every)) == 0).collect())
    cuts = F.array(*[F.lit(c) for c in sample[:: max(1, len(sample) // parts)]]).cast(f"array<{df.schema[id_col].dataType.simpleString()}>")
    stretch = F.size(F.filter(cuts, lambda c: c < F.col(id_col)))
    counts = {r["s"]: r["n"] for r in ids.groupBy(stretch.alias("s")).agg(F.count("*").alias("n")).collect()}
    below = 0
    for middle in sorted(counts):
        if below + counts[middle] >= half:
            break
        below += counts[middle]
    ranked = ids.where(stretch == middle).orderBy(id_col).limit(half - below)
    return df.withColumn(out, F.coalesce(F.col(id_col) <= ranked.agg(F.max(id_col)).scalar(), F.lit(False)))


def drop_nulls(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows complete in the required columns; a missing column is the caller's error."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.dropna(subset=list(required))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: ``n`` and the weight ``total / (classes * n)``."""
    counts = class_counts(df.where(F.col(label).isNotNull()), label)
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes")).alias("t")).scalar()
    weight = totals.getField("rows").cast("double") / (totals.getField("classes") * F.col("n"))
    return counts.select(label, "n", weight.alias("weight"))


def check_training_rows(df: DataFrame, label: str | None = None, min_rows: int = 1, min_classes: int = 2, text: str | None = None) -> dict:
    """Raise when there is too little to fit; return the numbers of rows and of classes, and with a label and a ``text`` column its bytes."""
    if label is None:
        rows, classes = df.count(), 0
    else:
        size = F.lit(0) if text is None else F.octet_length(F.col(text))
        each = df.groupBy(label).agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
        found = each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("classes"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
        rows, classes, held = found["rows"], found["classes"], found["bytes"]
    if rows < min_rows:
        raise ValueError(f"need at least {min_rows} rows to train, got {rows}")
    if label is not None and classes < min_classes:
        raise ValueError(f"need at least {min_classes} classes in {label}, got {classes}")
    return {"rows": rows, "classes": classes} | ({"bytes": held} if text is not None and label is not None else {})
