"""BPE encoding and decoding by a table of distinct words.

Texts are split into words; each slice of documents numbers its words as they first appear. The word lists are dealt by a hash
of the word, so that every distinct word meets in one bucket and is encoded once there, and the ids go back to the slices that asked. A slice
then joins ids to its words by position. Words are split twice, for the lists and for the positions, which is cheaper than to keep them. A word of any frequency is one row per slice; no text or id stream is shuffled
more than once, and nothing is broadcast but the vocabulary, whose size is fixed by the tokenizer's file. Decoding joins ids to
the pieces of that vocabulary.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import filled, id_array, ids, keyed, partitions, slices, text_bytes, worker_cache

#: Texts without these characters are normalised by lower-casing and splitting alone: nothing composes below U+0300.
UNUSUAL = re.compile("[\x1c-\x1f\u0300-\U0010ffff]")
#: Marks a special token among words; no word holds a blank.
MARK = " "
#: Bytes of text in a slice.
SLICE = 8 << 20


class WordTokenizer:
    """The parts of a tokenizer file: its normaliser, its word encoder, its special strings and its pieces."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        self.normalizer = whole.normalizer
        self.encoder = Tokenizer(whole.model)
        self.encoder.pre_tokenizer = whole.pre_tokenizer
        added = whole.get_added_tokens_decoder()
        self.special = {token.content: number for number, token in added.items()}
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if added else None
        vocabulary = whole.get_vocab(with_added_tokens=True)
        self.pieces = [""] * (max(vocabulary.values()) + 1)
        for piece, number in vocabulary.items():
            self.pieces[number] = piece

    def _plain_words(self, text: str) -> list[str]:
        if UNUSUAL.search(text):
            return [w for w in self.normalizer.normalize_str(text).split(" ") if w]
        return text.lower().split()

    def words(self, text: str) -> list[str]:
        if self.parts is None or not self.parts.search(text):
            return self._plain_words(text)
        out = []
        for part in self.parts.split(text):
            out.extend([MARK + part] if part in self.special else self._plain_words(part))
        return out

    def encode(self, words: list[str]) -> list[list[int]]:
        plain = iter([e.ids for e in self.encoder.encode_batch([w for w in words if not w.startswith(MARK)], add_special_tokens=False)])
        return [[self.special[w[len(MARK) :]]] if w.startswith(MARK) else next(plain) for w in words]


def machine(path: str) -> WordTokenizer:
    return worker_cache("word tokenizer " + path, lambda: WordTokenizer(path))


def squeeze(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: their high bytes are mostly alike."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes(), 1)


def widen(blob: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def numbered_slices(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[int, pa.RecordBatch, dict[str, int], np.ndarray, list[int]]]:
    """For each slice its number, its rows, its distinct words numbered as they first appear, the words of each row and all words by number."""
    tokenizer = machine(path)
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            texts = filled(part.column("text")).to_pylist()
            index: dict[str, int] = {}
            counts = np.zeros(len(texts), np.uint32)
            stream: list[int] = []
            for n, text in enumerate(texts):
                words = tokenizer.words(text)
                counts[n] = len(words)
                stream.extend([index.setdefault(w, len(index)) for w in words])
            yield number, part, index, counts, stream
            number += 1


def word_rows(source: DataFrame, path: str, buckets: int) -> DataFrame:
    """The distinct words of each slice, a row for each bucket: ``slice, bucket``, the words and their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, index, _, _ in numbered_slices(batches, path):
            words = list(index)
            if not words:
                continue
            bucket = np.fromiter((zlib.crc32(w.encode()) % buckets for w in words), np.int32, len(words))
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.r_[True, bucket[order[1:]] != bucket[order[:-1]]]).tolist()
            rows = []
            for a, b in zip(cuts, [*cuts[1:], len(words)], strict=True):
                own = order[a:b]
                rows.append((int(bucket[own[0]]), zstandard.compress("\n".join([words[i] for i in own.tolist()]).encode(), 3), squeeze(np.diff(own, prepend=0).astype(np.uint32))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2)]],
                ["slice", "bucket", "first", "second"],
            )

    return source.mapInArrow(run, "slice long, bucket int, first binary, second binary")


def document_rows(source: DataFrame, path: str) -> DataFrame:
    """A row for each slice (bucket -1): its ids, the words of each document, and all words by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part, _, counts, stream in numbered_slices(batches, path):
            blobs = squeeze(ids(part.column("doc_id"))), squeeze(counts), squeeze(np.array(stream, np.uint32))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([-1], pa.int32()), *[pa.array([b], pa.binary()) for b in blobs]], ["slice", "bucket", "first", "second", "third"]
            )

    return source.mapInArrow(run, "slice long, bucket int, first binary, second binary, third binary")


def encoded_words(words: DataFrame, path: str) -> DataFrame:
    """For each slice and bucket the ids of the slice's words; each distinct word is encoded once."""

    def run(table: pa.Table) -> pa.Table:
        tokenizer = machine(path)
        lists = [zstandard.decompress(x).decode().split("\n") for x in table.column("first").to_pylist()]
        distinct = list(dict.fromkeys(w for words in lists for w in words))
        known: dict[str, tuple[int, bytes]] = {}
        for at in range(0, len(distinct), 20_000):
            some = distinct[at : at + 20_000]
            for word, numbers in zip(some, tokenizer.encode(some), strict=True):
                known[word] = len(numbers), np.array(numbers, np.uint32).tobytes()
        lengths = [squeeze(np.fromiter((known[w][0] for w in words), np.uint32, len(words))) for words in lists]
        numbers = [squeeze(np.frombuffer(b"".join([known[w][1] for w in words]), np.uint32)) for words in lists]
        return pa.table({"slice": table.column("slice"), "bucket": table.column("bucket"), "first": table.column("second"), "second": pa.array(lengths, pa.binary()), "third": pa.array(numbers, pa.binary())})

    return words.groupBy("bucket").applyInArrow(run, "slice long, bucket int, first binary, second binary, third binary")


def bpe_round_trip(docs: DataFrame, tokenizer_path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, ids, decoded`` for every whole text: the ids of the tokenizer file's library without added special tokens, and
    what its decoder makes of them.

    Null and empty texts have no ids and decode to an empty text. Rows are handled one by one: repeated rows, null ids and
    ties come out as they went in; other columns are not read. Special strings inside texts become their ids.
    """

    def assemble(table: pa.Table) -> pa.Table:
        tokenizer = machine(tokenizer_path)
        rows = table.to_pylist()
        head = next(r for r in rows if r["bucket"] < 0)
        doc, counts, stream = widen(head["first"], "i8"), widen(head["second"], "u4"), widen(head["third"], "u4")
        size = np.full(int(stream.max()) + 1 if len(stream) else 0, -1, np.int64)
        place = np.zeros(len(size), np.int64)
        flat, base = [], 0
        for r in rows:
            if r["bucket"] >= 0:
                own, lengths, numbers = np.cumsum(widen(r["first"], "u4")), widen(r["second"], "u4").astype(np.int64), widen(r["third"], "u4")
                size[own] = lengths
                place[own] = base + np.cumsum(lengths) - lengths
                flat.append(numbers)
                base += len(numbers)
        if (size < 0).any():
            raise ValueError("a slice lacks ids of its words: the input gave other slices when it was read again")
        numbers = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        lengths = size[stream]
        before = np.cumsum(lengths) - lengths
        every = numbers[np.arange(int(lengths.sum())) + np.repeat(place[stream] - before, lengths)].astype(np.int32)
        word_bounds = np.r_[0, np.cumsum(counts.astype(np.int64))]
        bounds = np.r_[before, len(every)][word_bounds].astype(np.int32)
        piece = tokenizer.pieces.__getitem__
        decoded = [" ".join(map(piece, every[a:b].tolist())) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        return pa.table({"doc_id": id_array(doc), "ids": pa.ListArray.from_arrays(pa.array(bounds), pa.array(every)), "decoded": pa.array(decoded, pa.string())})

    source = keyed(docs.withColumn("text", F.col(text).cast("string")), id_col, "text")
    buckets = max(partitions(docs.sparkSession), text_bytes(source, "text") // (8 << 20) + 1)
    # Both branches read the same partitions of the input, so their slices are the same; assemble() checks it.
    joined = document_rows(source, tokenizer_path).unionByName(encoded_words(word_rows(source, tokenizer_path, buckets), tokenizer_path))
    return joined.groupBy("slice").applyInArrow(assemble, "doc_id long, ids array<int>, decoded string")


def digest_columns() -> list[Column]:
    """``n_tokens, ids_sha256, decoded_sha256`` of a row of ``bpe_round_trip``."""
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    ]
