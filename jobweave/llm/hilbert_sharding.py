"""Sharding along a Hilbert curve over quantised metadata.

Several metadata columns are quantised to a few bits each; the cell they form is a point whose index on a Hilbert curve orders the
rows. Runs of that order are shards, so a shard (and a file in it) covers a small box in every dimension and
readers skip files by any of them. Only DataFrame expressions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SUB_BUCKETS = 1 << 12


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Digit and next state of a Hilbert curve for each state and corner of the unit cube.

    A state is the entry corner and the axis along which the sub-curve runs. Within a cube the corners are visited in Gray
    code order; the rules for the entry and the axis of each sub-cube follow from that order.
    """
    size, mask = 1 << dims, (1 << dims) - 1

    def turn(value: int, by: int) -> int:
        by %= dims
        return ((value << by) | (value >> (dims - by))) & mask

    def ones_after(value: int) -> int:
        count = 0
        while value & 1:
            count, value = count + 1, value >> 1
        return count

    digits, nexts = [], []
    for axis in range(dims):
        for entry in range(size):
            for corner in range(size):
                gray = turn(corner ^ entry, -(axis + 1))
                digit = 0
                while gray:
                    digit, gray = digit ^ gray, gray >> 1
                start = 0 if digit == 0 else ((2 * ((digit - 1) // 2)) ^ (2 * ((digit - 1) // 2) >> 1))
                along = 0 if digit == 0 else (ones_after(digit - 1) if digit % 2 == 0 else ones_after(digit)) % dims
                new_entry = entry ^ turn(start, axis + 1)
                new_axis = (axis + along + 1) % dims
                digits.append(digit)
                nexts.append(new_axis * size + new_entry)
    return digits, nexts


def hilbert_index(coordinates: Sequence[Column], bits: int) -> Column:
    """The place on the curve of a cell; each coordinate is a whole number of ``bits`` bits."""
    dims = len(coordinates)
    size = 1 << dims
    digits, nexts = curve_tables(dims)
    digit_of = F.array(*[F.lit(d) for d in digits])
    next_of = F.array(*[F.lit(n) for n in nexts])
    cell = F.array(*[c.cast("int") for c in coordinates])

    def corner(level: Column) -> Column:
        return F.aggregate(cell, F.lit(0), lambda acc, x: acc * 2 + F.floor(x / F.pow(F.lit(2), level)).cast("int") % 2)

    steps = F.transform(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), corner)
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))
    walked = F.aggregate(
        steps,
        start,
        lambda acc, c: F.struct(
            F.get(next_of, acc["state"] * size + c).alias("state"),
            (acc["index"] * size + F.get(digit_of, acc["state"] * size + c)).cast("long").alias("index"),
        ),
    )
    return walked["index"]


def hashed_level(value: Column, bits: int) -> Column:
    """A categorical column as one of ``2 ** bits`` levels; null is the first."""
    return F.when(value.isNull(), F.lit(0)).otherwise(F.pmod(F.crc32(value.cast("string").cast("binary")), F.lit(1 << bits)).cast("int"))


def size_cuts(rows: DataFrame, column: str, ties: Sequence[str], bits: int) -> list[float]:
    """Upper ends of all levels of a number but the last: its quantiles over all rows. Tasks hand on a count per distinct number.

    All rows count, so ``ties``, which a choice of rows would go by, are not read.
    """
    levels = 1 << bits
    found = rows.agg(F.percentile(column, F.array(*[F.lit(n / levels) for n in range(1, levels)])).alias("q")).first()["q"]
    return sorted(set(found or []))


def ranged_level(value: Column, cuts: Sequence[float]) -> Column:
    """How many cuts lie below a number; null counts as none. Levels hold about as many rows each, so the largest numbers are told apart as well."""
    ends = F.array(*[F.lit(float(c)) for c in cuts]).cast("array<double>")
    return F.size(F.filter(ends, lambda c: c < F.coalesce(value, F.lit(0)).cast("double"))).cast("int")


def hilbert_shards(
    frame: DataFrame, coordinates: Sequence[Column], bits: int, shards: int, ties: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """``columns``, ``curve_index``, ``shard`` and ``slot`` (gapless from 0 in each shard) for every row.

    Law ``rows``: the order along the curve is cut into runs whose numbers of rows differ by one at most. ``ties`` order rows
    of one cell; rows equal in all of them are alike and share their places in any order. Nulls and clashing extra columns
    do no harm: only ``columns`` and the coordinates are read. An empty table gives an empty result.

    Ranks need no window over all rows. A hash of ``ties`` cuts every cell into sub-buckets, so a hot cell is ranked by many
    tasks; the counts of (cell, sub-bucket) are summed within cells, and cells (at most ``2 ** (bits * dims)`` rows, a bound
    that does not grow with the data) in one window.
    """
    placed = frame.select(*columns, hilbert_index(coordinates, bits).alias("curve_index"))
    placed = placed.withColumn("_hash", F.xxhash64(*[F.col(t) for t in ties]))
    placed = placed.withColumn("_sub", F.pmod("_hash", F.lit(SUB_BUCKETS)).cast("int"))
    counts = placed.groupBy("curve_index", "_sub").agg(F.count(F.lit(1)).alias("_n"))
    in_cell = Window.partitionBy("curve_index").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    within = counts.withColumn("_within", F.coalesce(F.sum("_n").over(in_cell), F.lit(0)))
    cells = counts.groupBy("curve_index").agg(F.sum("_n").alias("_cell"))
    before = Window.orderBy("curve_index").rowsBetween(Window.unboundedPreceding, -1)
    all_cells = Window.orderBy("curve_index").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = cells.select(
        "curve_index", F.coalesce(F.sum("_cell").over(before), F.lit(0)).alias("_before"), F.sum("_cell").over(all_cells).alias("_rows")
    )
    bases = within.join(offsets, "curve_index").select("curve_index", "_sub", (F.col("_before") + F.col("_within")).alias("_base"), "_rows")
    own = Window.partitionBy("curve_index", "_sub").orderBy("_hash", *ties)
    ranks = placed.withColumn("_place", F.row_number().over(own) - 1).join(bases, ["curve_index", "_sub"])
    ranks = ranks.withColumn("_rank", F.col("_base") + F.col("_place"))
    shard = F.expr(f"(_rank * {shards}) div _rows").cast("int")
    return ranks.withColumn("shard", shard).select(
        *columns, "curve_index", "shard", (F.col("_rank") - F.expr(f"(shard * _rows + {shards - 1}) div {shards}")).alias("slot")
    )


def write_shards(frame: DataFrame, path: str, shards: int) -> None:
    """The rows of ``hilbert_shards`` as files in curve order, one folder per shard: footers then hold narrow ranges."""
    frame.repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def document_shards(docs: DataFrame, shards: int = 16, bits: int = 5) -> DataFrame:
    """Documents on a curve over language, source and size: the columns of the sharding report.

    ``size`` is the text's UTF-8 bytes (none for null) plus one; ``text_crc32`` that of the text's bytes, of no bytes for null.
    """
    rows = document_metadata(docs)
    ties = ["doc_id", "text_crc32", "size"]
    cuts = size_cuts(rows, "size", ties, bits)
    coordinates = [hashed_level(F.col("lang"), bits), hashed_level(F.col("source"), bits), ranged_level(F.col("size"), cuts)]
    placed = hilbert_shards(rows, coordinates, bits, shards, ties, ["doc_id", "size", "text_crc32", "lang", "source"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "curve_index",
    )


def document_metadata(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), "lang", "source")
