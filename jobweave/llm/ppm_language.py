"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to ``ORDER`` bytes. A byte costs its share of the counts in the longest known
context; each context that has not seen it costs an escape (the number of distinct bytes over that number plus all counts), one that the language has never
seen costs nothing; a byte that no context has seen costs eight bits more. The statistics are frozen after fitting, so the code length of a byte
depends on the bytes before it alone. All contexts, bytes and counts of the sample are kept, and lengths are double precision. A text's language is the one with
the shortest code.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import filled, slices, text_buffer

ORDER = 3
#: Documents of a language that its tree is fitted on at most, about; chosen by a hash of the id.
SAMPLE_DOCS = 1500
#: Bytes of text that a task counts or scores at a time.
SCORED_BYTES = 1 << 20
#: Stands before a text; no byte of UTF-8.
START = 255
UNKNOWN = "und"


@dataclass
class Tree:
    """For contexts of each length: sorted codes of a context with a byte and its bits, sorted codes of contexts and the bits of their escape.

    A code has the latest byte lowest.
    """

    pairs: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def lengths(self, codes: np.ndarray) -> np.ndarray:
        """Bits of the lowest byte of each code after the ``ORDER`` bytes above it."""
        out, rest = np.zeros(len(codes)), np.arange(len(codes))
        for depth in range(ORDER, -1, -1):
            key = codes[rest] & np.int64((1 << 8 * (depth + 1)) - 1)
            at, hit = found_at(self.pairs[depth], key)
            out[rest[hit]] += self.bits[depth][at[hit]]
            rest, key = rest[~hit], key[~hit]
            at, known = found_at(self.contexts[depth], key >> 8)
            out[rest[known]] += self.escapes[depth][at[known]]
        out[rest] += 8.0
        return out


@dataclass
class Model:
    languages: list[str]
    trees: list[Tree]


def found_at(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each key in a sorted table, and whether it is there."""
    at = np.searchsorted(table, keys)
    hit = at < len(table)
    hit[hit] = table[at[hit]] == keys[hit]
    return at, hit


def fold(id_col: str = "doc_id") -> Column:
    """Whether a document is held out: its id's CRC-32 as text is a multiple of five (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def byte_codes_of(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each byte of each row the code of itself and the ``ORDER`` bytes before it, start marks where there are none."""
    codes = data.astype(np.uint32)
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    ends = bounds[1:][bounds[:-1] < bounds[1:]]
    for back in range(1, ORDER + 1):
        before = np.full(len(data), START, np.uint32)
        before[back:] = data[:-back]
        for place in range(back):
            # the first bytes of a row have no byte so far before them
            first = heads + place
            before[first[first < ends]] = START
        codes |= before << np.uint32(8 * back)
    return codes


def context_counts(sample: DataFrame) -> DataFrame:
    """``lang, code, n``: how often each byte stands after each run of up to ``ORDER`` bytes; the code's bits from 40 on tell the number of bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SCORED_BYTES):
                data, bounds = text_buffer(filled(part.column("text")))
                coded = part.column("lang").dictionary_encode()
                language = np.repeat(coded.indices.to_numpy(zero_copy_only=False), np.diff(bounds))
                codes = byte_codes_of(data, bounds)
                for number, name in enumerate(coded.dictionary.to_pylist()):
                    own = codes[language == number]
                    for size in range(1, ORDER + 2):
                        values, n = np.unique(own & np.uint32((1 << 8 * size) - 1), return_counts=True)
                        values = values.astype(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(values), pa.string()), pa.array(values | (size << 40)), pa.array(n.astype(np.int64))], ["lang", "code", "n"]
                        )

    return sample.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model from labelled rows outside the held-out fold: about ``sample_docs`` whole texts of each language at most."""
    rows = docs.where(~fold(id_col)).select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)).alias("_at")
    ).where("lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], [])
    wanted = F.coalesce(
        *[F.when(F.col("lang") == name, F.lit(int((1 << 30) * min(1.0, sample_docs / n)))) for name, n in sorted(sizes.items())], F.lit(0)
    )
    found = context_counts(rows.where(F.col("_at") < wanted).drop("_at")).orderBy("lang", "code").toArrow()
    languages, codes, counts = found.column("lang").combine_chunks().dictionary_encode(), found.column("code").to_numpy(), found.column("n").to_numpy()
    names, number = languages.dictionary.to_pylist(), languages.indices.to_numpy()
    return Model(names, [grow(codes[number == i], counts[number == i]) for i in range(len(names))])


def grow(codes: np.ndarray, counts: np.ndarray) -> Tree:
    """The tree of sorted codes with their sizes, as ``context_counts`` gives them."""
    tree = Tree([], [], [], [])
    for size in range(1, ORDER + 2):
        own = codes >> 40 == size
        pairs, n = codes[own] & np.int64((1 << 40) - 1), counts[own]
        order = np.argsort(pairs)
        pairs, n = pairs[order], n[order]
        contexts, of = np.unique(pairs >> 8, return_inverse=True)
        total, distinct = np.bincount(of, n, len(contexts)), np.bincount(of, minlength=len(contexts))
        tree.pairs.append(pairs)
        tree.bits.append(np.log2((total + distinct)[of] / n))
        tree.contexts.append(contexts)
        tree.escapes.append(np.log2((total + distinct) / np.maximum(distinct, 1)))
    return tree


def identify(docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, bits_per_byte`` for every whole text.

    ``score`` is the share of the best language when each weighs two to the power of minus its code length. A null text, or one
    without letters, is ``und`` with score 0, and so is every text if nothing could be learned; equal lengths go to the first language
    by name. Rows are judged one by one; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = shared.value
        for batch in batches:
            for part in slices(batch, "text", SCORED_BYTES):
                column = filled(part.column("text"))
                data, bounds = text_buffer(column)
                letters = np.fromiter((any(map(str.isalpha, t)) for t in column.to_pylist()), bool, len(column))
                rows = len(column)
                bits = np.zeros((rows, max(1, len(frozen.languages))))
                full = np.flatnonzero(np.diff(bounds))
                if len(full) and frozen.languages:
                    codes, which = np.unique(byte_codes_of(data, bounds), return_inverse=True)
                    for n, tree in enumerate(frozen.trees):
                        bits[full, n] = np.add.reduceat(tree.lengths(codes.astype(np.int64))[which], bounds[full])
                best = bits.argmin(axis=1)
                least = bits[np.arange(rows), best]
                score = 1 / np.exp2(least[:, None] - bits).sum(axis=1)
                good = letters & bool(frozen.languages)
                names = [frozen.languages[b] if g else UNKNOWN for b, g in zip(best.tolist(), good.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names), pa.array(np.where(good, score, 0.0)), pa.array(np.where(good, least / np.maximum(np.diff(bounds), 1), 0.0))],
                    ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"],
                )

    source = docs.select(F.col(id_col).alias("doc_id"), fold(id_col).alias("held_out"), F.col(text).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, bits_per_byte double")
