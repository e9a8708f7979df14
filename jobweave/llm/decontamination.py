"""Benchmark decontamination by a prefix-filtered set join.

The windows of the benchmark (runs of ten words, or a whole shorter item) are the sets to be contained. Words are ordered by rarity
in the documents. A window can only be contained where its rarest word stands, so that word alone is the necessary prefix
(full containment leaves a prefix of one); the word's place in the window and the document's length bound where the window would
begin and end; what passes is joined with the windows on prefix and words.

The documents are read twice, whatever the size of the benchmark: once for the rarity of its words, once for the places of its prefixes. Which
words, prefixes and windows there are is sent to the tasks as bitmaps of fixed size. A bitmap lets through all that is there and, when it is full, more
than that; the join decides. Rows are told apart by id and text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import bitmap, filled, is_set, mix, prefix_hashes, row_keys, slices, text_buffer, word_hashes, words_of, written

WINDOW = 10
#: Windows that a task takes apart at a time.
BLOCK = 50_000
#: Bytes that are no part of a word read as blanks, A to Z as a to z.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
FOLDED = np.frombuffer(FOLD, np.uint8)
NO_WORD = np.arange(256) == 32


def folded_words(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """``window, item_id``: each window of each item, as its words joined by blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body in zip(batch.column("item_id").to_pylist(), filled(batch.column("text")).to_pylist(), strict=True):
                words = folded_words(body.encode())
                if not words:
                    continue
                found = sorted({b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))})
                for at in range(0, len(found), 10_000):
                    some = [w.decode() for w in found[at : at + 10_000]]
                    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([name] * len(some), pa.string())], ["window", "item_id"])

    source = items.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, "window string, item_id string")


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a run of texts: folded bytes, starts, ends and hashes of the words, and the number of words before each row."""
    data, bounds = text_buffer(filled(column))
    data = FOLDED[data]
    starts, ends, before = words_of(data, bounds, NO_WORD)
    return data, starts, ends, word_hashes(data, starts, ends), before


def window_words(windows: DataFrame, block: int) -> DataFrame:
    """``window, size, whole, place, h``: of each window the hash of all its words in order, and each word's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                _, _, _, hashes, before = hashed_words(part.column("window"))
                size = np.diff(before)
                row = np.repeat(np.arange(part.num_rows), size)
                whole = mix(prefix_hashes(hashes, before[:-1], before[1:])).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("window").take(pa.array(row)), pa.array(size[row].astype(np.int32)), pa.array(whole[row]), pa.array((np.arange(len(row)) - before[row]).astype(np.int32)), pa.array(hashes.view(np.int64))],
                    ["window", "size", "whole", "place", "h"],
                )

    return windows.mapInArrow(run, "window string, size int, whole long, place int, h long")


def word_rarity(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """``h, n``: how often the words of the bitmap stand in the documents, counted in slices first."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes = hashed_words(part.column("text"))[3]
                found, n = np.unique(hashes[is_set(shared.value, hashes)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    return docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def possible_places(docs: DataFrame, prefixes: np.ndarray, wholes: np.ndarray, shapes: list[tuple[int, int]]) -> DataFrame:
    """``key, id, n_words, found`` per row: where a window may stand, as (begin, size, prefix, window).

    ``shapes`` are the sizes of windows and the places of a prefix in them; a place that would begin before the text or end behind it is none.
    """
    shared = docs.sparkSession.sparkContext.broadcast((prefixes, wholes))
    shape = np.array(shapes, np.int64).reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix_bits, whole_bits = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                data, starts, ends, hashes, before = hashed_words(part.column("text"))
                at = np.flatnonzero(is_set(prefix_bits, hashes))
                row = np.searchsorted(before, at, "right") - 1
                at, row = np.repeat(at, len(shape)), np.repeat(row, len(shape))
                size, place = np.tile(shape, (len(at) // max(len(shape), 1), 1)).T if len(at) else (at, at)
                begin = at - place
                fits = (begin >= before[row]) & (begin + size <= before[row + 1])
                at, row, size, begin = at[fits], row[fits], size[fits], begin[fits]
                near = is_set(whole_bits, mix(prefix_hashes(hashes, begin, begin + size)))
                at, row, size, begin = at[near], row[near], size[near], begin[near]
                raw = data.tobytes()
                each = [
                    {"begin": int(b - before[r]), "size": int(n), "prefix": int(p), "window": b" ".join([raw[starts[w] : ends[w]] for w in range(b, b + n)]).decode()}
                    for b, n, r, p in zip(begin.tolist(), size.tolist(), row.tolist(), hashes[at].view(np.int64).tolist(), strict=True)
                ]
                own = np.searchsorted(row, np.arange(part.num_rows + 1)).tolist()
                kind = pa.list_(pa.struct([("begin", pa.int32()), ("size", pa.int32()), ("prefix", pa.int64()), ("window", pa.string())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("id"), pa.array(np.diff(before).astype(np.int64)), pa.array([each[a:b] for a, b in zip(own[:-1], own[1:], strict=True)], kind)],
                    ["key", "id", "n_words", "found"],
                )

    return docs.select("key", "id", "text").mapInArrow(run, "key long, id long, n_words long, found array<struct<begin:int,size:int,prefix:long,window:string>>")


def decontaminate(
    docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block: int = BLOCK,
) -> DataFrame:
    """``doc_id, n_words, n_hit, item_ids`` (sorted strings) for every document.

    Null and empty texts have no words; an item without words hits nothing. Items with a null id hit words
    but are not listed. Every row comes out with hits and items of its own text, whatever ids are null, shared or repeated.
    Empty tables give no rows, or rows without hits. Other columns are not read.
    """
    rows, _ = row_keys(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text")), "id", "text", "key")
    pairs = written(item_windows(items, item_id, item_text, window), "windows")
    words = written(window_words(pairs.select("window").distinct(), block), "window-words")
    rarity = word_rarity(rows, bitmap(words.select("h")))
    ranked = words.join(rarity, "h").groupBy("window", "size", "whole").agg(F.count("*").alias("known"), F.min(F.struct("n", "h", "place")).alias("first"))
    # a window with a word that no document holds stands nowhere
    index = written(ranked.where("known = size").select("window", "size", "whole", F.col("first.h").alias("prefix"), F.col("first.place").alias("place")), "window-index")
    shapes = [(r["size"], r["place"]) for r in index.select("size", "place").distinct().collect()]
    prefixes, wholes = (bitmap(index.select(F.col(c).alias("h"))) for c in ("prefix", "whole"))
    read = written(possible_places(rows, prefixes, wholes, shapes), "places")
    places = read.select("key", F.explode("found").alias("f")).select("key", "f.*")
    hits = places.join(index.select("prefix", "window"), ["prefix", "window"])
    spans = F.flatten(F.collect_set(F.sequence("begin", F.col("begin") + F.col("size") - 1)))
    hit = hits.groupBy("key").agg(F.size(F.array_distinct(spans)).cast("long").alias("n_hit"))
    listed = hits.select("key", "window").distinct().join(pairs.distinct(), "window").groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    return read.join(hit, "key", "left").join(listed, "key", "left").select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")
    )


def contamination_report(hits: DataFrame) -> DataFrame:
    """The digest columns of ``decontaminate``."""
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
