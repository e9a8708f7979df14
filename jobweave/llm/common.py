"""Helpers shared by the operators: text slices, worker caches, packed exchanges, scratch tables."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.session import swept, written as written

NULL_ID = -(1 << 63)
SLICE_BYTES = 4 << 20


def worker_cache(key: str, make: Callable[[], object]) -> object:
    """``make()`` once per Python worker: tasks arrive with fresh globals, modules stay."""
    store = sys.modules.setdefault("_jobweave_worker_cache", types.ModuleType("_jobweave_worker_cache"))
    if not hasattr(store, "kept"):
        store.kept = {}
    if key not in store.kept:
        store.kept[key] = make()
    return store.kept[key]


def filled(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A string column as one array with null read as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "")


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a filled string column and the bounds of its rows in them."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    raw = column.buffers()
    bounds = np.frombuffer(raw[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw[2], dtype=np.uint8) if raw[2] is not None and raw[2].size else np.zeros(0, np.uint8)
    bounds = bounds.astype(np.int64)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole rows of about ``most`` text bytes; one longer text is a run of its own."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.binary_length(filled(batch.column(column))).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def ids(column: pa.Array) -> np.ndarray:
    """Integer ids with null as the lowest id."""
    return pc.fill_null(column.cast(pa.int64()), NULL_ID).to_numpy(zero_copy_only=False)


def id_array(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=np.asarray(values) == NULL_ID)


def keyed(docs: DataFrame, id_col: str, *columns: str) -> DataFrame:
    """``doc_id`` as long (null as the lowest id) and the named columns, nothing else of the input."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"), *[F.col(c) for c in columns]
    )


def row_keys(docs: DataFrame, id_col: str, text: str, key: str) -> tuple[DataFrame, bool]:
    """The rows with a long ``key``, and whether rows share one: equal where id and text are equal (null reads as empty text), ordered by id, null first.

    Where every id has one text, the key is the id, with null as the lowest. Else the distinct pairs of id and text digest are numbered in
    their order, in a written table, so that a repeated task finds the same keys.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    named = docs.withColumn(key, F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)))
    hashed = named.select(key, F.xxhash64(body).alias("x"), F.xxhash64(F.lit(1), body).alias("y"))
    each = hashed.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{c}{i}") for c in "xy" for i, f in enumerate((F.min, F.max))])
    with swept(docs.sparkSession):
        shared, mixed = each.agg(F.coalesce(F.max("n"), F.lit(0)) > 1, F.coalesce(F.max((F.col("x0") != F.col("x1")) | (F.col("y0") != F.col("y1"))), F.lit(False))).first()
    if not mixed:
        return named, shared
    named = named.withColumnRenamed(key, "_row_id").withColumn("_row_digest", F.sha2(body, 256))
    pairs = named.select("_row_id", "_row_digest").distinct().orderBy("_row_id", "_row_digest")
    numbered = written(pairs.withColumn(key, F.monotonically_increasing_id()), "row-keys")
    return named.join(numbered, ["_row_id", "_row_digest"]).drop("_row_id", "_row_digest"), shared


def real_id(column: str = "doc_id") -> Column:
    return F.when(F.col(column) != NULL_ID, F.col(column))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))).first()[0]


def pack(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """Rows given as equally long arrays, as one run of bytes per column and bucket."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    sorted_bucket = bucket[order]
    cuts = np.flatnonzero(np.r_[True, sorted_bucket[1:] != sorted_bucket[:-1]])
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        yield int(sorted_bucket[a]), [c[order[a:b]].tobytes() for c in columns]


def unpack(table: pa.Table, names: list[str], types_: list[str]) -> list[np.ndarray]:
    """The rows of all blobs of a table, column by column."""
    return [
        np.frombuffer(b"".join(table.column(n).to_pylist()), dtype=t) for n, t in zip(names, types_, strict=True)
    ]


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the output."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xA0761D6478BD642F)
    values ^= values >> np.uint64(32)
    return values


def byte_codes() -> np.ndarray:
    """A random 64-bit code for each byte value, from a fixed seed."""
    return np.random.default_rng(20231).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


#: Bytes that part words: blank and the controls 9 to 13.
BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words_of(data: np.ndarray, bounds: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of each row, and for each row bound the number of words before it. ``blank`` tells for each byte value whether it parts words."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~blank[data]
    first = (inside[1:-1] == 1) & (inside[:-2] == 0)
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    first[heads] |= inside[1:-1][heads] == 1
    starts = np.flatnonzero(first)
    last = (inside[1:-1] == 1) & (inside[2:] == 0)
    last[heads[1:] - 1] |= inside[1:-1][heads[1:] - 1] == 1
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial over random byte codes, then mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    base = np.uint64(0x9E3779B97F4A7C15)
    powers = np.ones(int(lengths.max()), np.uint64)
    if len(powers) > 1:
        powers[1:] = np.multiply.accumulate(np.full(len(powers) - 1, base))
    parts = byte_codes()[data[place + np.repeat(starts, lengths)]] * powers[place]
    return mix(np.add.reduceat(parts, first) + lengths.astype(np.uint64))


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers byte by byte, lowest bytes first, compressed: small numbers take little room."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64).ravel()


#: Bits of a bitmap that is sent to every task: 8 MB.
BITS = 1 << 26


def bitmap(hashes: DataFrame, bits: int = BITS) -> np.ndarray:
    """The bits of the 64-bit numbers of a column ``h``. Every task sends what it has of a table of fixed size."""
    place = F.pmod("h", F.lit(bits))
    with swept(hashes.sparkSession):
        parts = hashes.groupBy(F.floor(place / F.lit(32768)).cast("int").alias("part")).agg(F.bitmap_construct_agg(place % 32768).alias("bits")).collect()
    out = np.zeros((bits // 32768, 4096), np.uint8)
    for r in parts:
        out[r["part"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out.ravel()


def is_set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each number is set: always for those of the bitmap, and for others the more often the fuller it is."""
    place = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def prefix_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The Rabin-Karp hash modulo 2^64 of each run of values: a difference of prefix polynomials, moved to power 0 by the base's inverse."""
    base = 0x9E3779B97F4A7C15
    powers, back = (np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(values), b, np.uint64)]) for b in (base, pow(base, -1, 1 << 64)))
    prefix = np.r_[np.uint64(0), np.cumsum(values * powers[:-1])]
    return (prefix[ends] - prefix[starts]) * back[starts]
