"""Quality rules with line sequence labelling by a linear-chain conditional random field.

Lines carry binned features (length, symbols, capitals, repetition, closing mark, place). The chain's weights are fitted on documents with a
quality label, whose lines all take the document's label: in sum, ordinary lines stand far more often in good documents, so a
mixed document's ordinary lines do not become boilerplate. Viterbi decoding marks each line as content or boilerplate; the
share of content decides about the document, after two plain rules on the words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import filled, mix, slices, text_buffer, word_hashes, words_of

#: Labelled documents that the chain is fitted on at most, about; chosen by a hash of the id.
SAMPLE_DOCS = 4000
#: Least share of word characters in content lines.
CONTENT_SHARE = 0.5
SYMBOLS = b"#*$%&|<>"
FEATURES = 32


@dataclass
class Chain:
    """Weights of features (for content), of transitions (from, to) and of the first line's label (0 boilerplate, 1 content)."""

    weights: np.ndarray
    moves: np.ndarray
    first: np.ndarray


def counted(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(mask)]
    return total[ends] - total[starts]


def binned(values: np.ndarray, edges: list[float]) -> np.ndarray:
    return np.searchsorted(np.array(edges), values, "right")


def measure(data: np.ndarray, bounds: np.ndarray) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Counts per document, and per line with a word: its document, word characters and feature numbers."""
    rows = len(bounds) - 1
    starts, ends, words = words_of(data, bounds)
    n_words = np.diff(words)
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    whole = (np.cumsum(edge)[:-1] > 0) & ((data & 0xC0) != 0x80)
    symbol = np.isin(data, np.frombuffer(SYMBOLS, np.uint8))
    hashed = word_hashes(data, starts, ends)
    doc_of_word = np.repeat(np.arange(rows), n_words)
    windows = np.zeros(0, np.int64)
    repeats = np.zeros(rows, np.int64)
    if len(hashed) > 2:
        windows = np.flatnonzero(doc_of_word[2:] == doc_of_word[:-2])
        key = hashed[windows] * np.uint64(0x9E3779B97F4A7C15) + hashed[windows + 1] * np.uint64(0xC2B2AE3D27D4EB4F) + hashed[windows + 2]
        key = mix(key + doc_of_word[windows].astype(np.uint64) * np.uint64(0x165667B19E3779F9))
        order = np.argsort(key, kind="stable")
        same = np.r_[False, key[order[1:]] == key[order[:-1]]] if len(key) else np.zeros(0, bool)
        twice = order[same | np.r_[same[1:], False]] if len(key) else order
        cover = np.zeros(len(hashed), bool)
        for n in range(3):
            cover[windows[twice] + n] = True
        repeats = np.bincount(doc_of_word[cover], minlength=rows)
    breaks = np.flatnonzero(data == 10)
    head = np.unique(np.r_[bounds[:-1], breaks + 1])
    head = head[head < len(data)]
    tail = np.r_[head[1:], len(data)] if len(head) else head
    tail = tail - ((tail > head) & (data[tail - 1] == 10)) if len(head) else tail
    line_words = np.searchsorted(starts, tail) - np.searchsorted(starts, head)
    head, tail, line_words = head[line_words > 0], tail[line_words > 0], line_words[line_words > 0]
    doc = np.searchsorted(bounds, head, "right") - 1
    key = mix(word_hashes(data, head, tail) + doc.astype(np.uint64) * np.uint64(0x165667B19E3779F9))
    order = np.argsort(key, kind="stable")
    repeated = np.zeros(len(head), bool)
    if len(head):
        repeated[order[1:]] = key[order[1:]] == key[order[:-1]]
    documents = {
        "n_words": n_words, "word_chars": counted(whole, bounds[:-1], bounds[1:]), "n_symbols": counted(symbol, bounds[:-1], bounds[1:]),
        "n_dup_lines": np.bincount(doc[repeated], minlength=rows), "n_repeat_words": repeats,
    }
    return documents, {"doc": doc, "chars": counted(whole, head, tail)} | line_features(data, head, tail, line_words, doc, repeated, symbol, hashed, starts)


def line_features(
    data: np.ndarray, head: np.ndarray, tail: np.ndarray, words: np.ndarray, doc: np.ndarray, repeated: np.ndarray, symbol: np.ndarray, hashed: np.ndarray, starts: np.ndarray
) -> dict[str, np.ndarray]:
    """``features``: the numbers of the features of each line, in columns (the last one stands for none)."""
    size = np.maximum(tail - head, 1)
    capital = counted((data >= 65) & (data <= 90), head, tail)
    letters = np.maximum(capital + counted((data >= 97) & (data <= 122), head, tail), 1)
    line_of_word = np.searchsorted(head, starts, "right") - 1
    key = mix(hashed + line_of_word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    fresh = np.r_[True, key[order[1:]] != key[order[:-1]]] if len(key) else np.zeros(0, bool)
    distinct = np.bincount(line_of_word[order[fresh]], minlength=len(head)) if len(head) else np.zeros(0, np.int64)
    last = data[np.maximum(tail - 1, 0)] if len(tail) else np.zeros(0, np.uint8)
    opening = np.r_[True, doc[1:] != doc[:-1]] if len(doc) else np.zeros(0, bool)
    closing = np.r_[opening[1:], True] if len(doc) else opening
    none = FEATURES - 1
    columns = [
        binned(size, [16, 64, 256, 1024, 4096]),
        6 + binned(counted(symbol, head, tail) / size, [1e-9, 0.02, 0.05, 0.15]),
        11 + binned(capital / letters, [0.1, 0.3, 0.6]),
        15 + np.where(words < 8, 4, binned(distinct / np.maximum(words, 1), [0.2, 0.4, 0.6])),
        20 + binned(counted(data == 33, head, tail) / size, [0.01, 0.05]),
        np.where(np.isin(last, np.frombuffer(b".!?", np.uint8)), 23, 24),
        np.where(counted((data >= 48) & (data <= 57), head, tail) > 0.2 * size, 25, none),
        np.where(repeated, 26, none), np.where(opening, 27, none), np.where(closing, 28, none), np.where(words < 3, 29, none),
        np.full(len(head), 30),
    ]
    return {"features": np.stack(columns, axis=1).astype(np.int16) if len(head) else np.zeros((0, len(columns)), np.int16)}


def by_step(doc: np.ndarray) -> list[np.ndarray]:
    """For each place in a document the line numbers that stand there, documents with more lines first."""
    if not len(doc):
        return []
    heads = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    counts = np.diff(np.r_[heads, len(doc)])
    order = np.argsort(-counts, kind="stable")
    heads, counts = heads[order], counts[order]
    return [heads[: int(np.searchsorted(-counts, -step, "left"))] + step for step in range(int(counts[0]))]


def scores(chain: Chain, features: np.ndarray) -> np.ndarray:
    return np.stack([np.zeros(len(features)), chain.weights[features].sum(axis=1)], axis=1)


def viterbi(chain: Chain, features: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The most likely label of every line; equal scores go to content."""
    node, steps = scores(chain, features), by_step(doc)
    back = np.zeros((len(doc), 2), np.int8)
    best = np.zeros((len(doc), 2))
    for n, at in enumerate(steps):
        if n == 0:
            best[at] = node[at] + chain.first
            continue
        ways = best[at - 1][:, :, None] + chain.moves[None]
        back[at] = np.where(ways[:, 1] >= ways[:, 0], 1, 0)
        best[at] = node[at] + ways.max(axis=1)
    label = np.where(best[:, 1] >= best[:, 0], 1, 0) if len(doc) else np.zeros(0, np.int64)
    for n in range(len(steps) - 2, -1, -1):
        following = steps[n + 1]
        label[following - 1] = back[following, label[following]]
    return label


def fit_chain(features: np.ndarray, doc: np.ndarray, label: np.ndarray, rounds: int = 150, ridge: float = 1e-4) -> Chain:
    """Weights of greatest conditional likelihood: forward and backward sums, all documents at once, adaptive steps."""
    chain = Chain(np.zeros(FEATURES), np.zeros((2, 2)), np.zeros(2))
    if not len(doc) or len(set(label.tolist())) < 2:
        chain.weights[30] = 1.0
        return chain
    steps = by_step(doc)
    later = np.concatenate(steps[1:]) if len(steps) > 1 else np.zeros(0, np.int64)
    real_moves = np.bincount(label[later - 1] * 2 + label[later], minlength=4).reshape(2, 2)
    real_first = np.bincount(label[steps[0]], minlength=2)
    momentum, scale = np.zeros(FEATURES + 6), np.zeros(FEATURES + 6)
    flat_features = features.ravel()
    real_weights = np.bincount(flat_features, np.repeat(label, features.shape[1]), FEATURES)
    for turn in range(1, rounds + 1):
        node = scores(chain, features)
        forward, backward = np.zeros((len(doc), 2)), np.zeros((len(doc), 2))
        for n, at in enumerate(steps):
            before = chain.first if n == 0 else np.logaddexp.reduce(forward[at - 1][:, :, None] + chain.moves[None], axis=1)
            forward[at] = node[at] + before
        for at in reversed(steps[1:]):
            backward[at - 1] = np.logaddexp.reduce(chain.moves[None] + (node[at] + backward[at])[:, None, :], axis=2)
        total = np.logaddexp.reduce(forward + backward, axis=1)
        chance = np.exp(forward + backward - total[:, None])
        pairs = np.exp(forward[later - 1][:, :, None] + chain.moves[None] + (node[later] + backward[later])[:, None, :] - total[later][:, None, None])
        gradient = np.r_[
            real_weights - np.bincount(flat_features, np.repeat(chance[:, 1], features.shape[1]), FEATURES),
            (real_moves - pairs.sum(axis=0)).ravel(), real_first - chance[steps[0]].sum(axis=0),
        ] / len(doc)
        state = np.r_[chain.weights, chain.moves.ravel(), chain.first]
        gradient -= ridge * state
        momentum = 0.9 * momentum + 0.1 * gradient
        scale = 0.99 * scale + 0.01 * gradient**2
        state = state + 0.1 * (momentum / (1 - 0.9**turn)) / (np.sqrt(scale / (1 - 0.99**turn)) + 1e-8)
        state[FEATURES - 1] = 0.0
        chain = Chain(state[:FEATURES], state[FEATURES : FEATURES + 4].reshape(2, 2), state[FEATURES + 4 :])
    return chain


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", quality: str = "quality", sample_docs: int = SAMPLE_DOCS) -> Chain:
    """The chain from about ``sample_docs`` labelled documents at most, whole texts; rows with a null label or text are passed over."""
    known = labels.where(F.col(quality).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(quality).cast("int").alias("_label"))
    share = min(1.0, sample_docs / max(1, known.count()))
    some = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(share * (1 << 30))).groupBy("_id").agg(F.max("_label").alias("_label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                _, lines = measure(*text_buffer(filled(part.column("text"))))
                label = np.array(part.column("label").to_pylist(), np.int64)
                heads = np.flatnonzero(np.r_[True, lines["doc"][1:] != lines["doc"][:-1]]) if len(lines["doc"]) else np.zeros(0, np.int64)
                ends = np.r_[heads[1:], len(lines["doc"])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(label[lines["doc"][heads]]), pa.array([lines["features"][a:b].tobytes() for a, b in zip(heads, ends, strict=False)], pa.binary())],
                    ["label", "lines"],
                )

    # the sample's size is bounded by its parameter, so it may be sent to every task
    rows = docs.join(F.broadcast(some), F.col(id_col) == F.col("_id")).where(F.col(text).isNotNull())
    found = rows.select(F.col(text).cast("string").alias("text"), F.col("_label").alias("label")).mapInArrow(run, "label long, lines binary").toArrow()
    order = sorted(zip(found.column("lines").to_pylist(), found.column("label").to_pylist(), strict=True))
    width = len(measure(np.frombuffer(b"a", np.uint8), np.array([0, 1]))[1]["features"][0])
    blocks = [np.frombuffer(b, np.int16).reshape(-1, width) for b, _ in order]
    sizes = np.fromiter(map(len, blocks), np.int64, len(blocks))
    features = np.concatenate(blocks) if blocks else np.zeros((0, width), np.int16)
    label = np.repeat(np.array([x for _, x in order], np.int64), sizes)
    return fit_chain(features, np.repeat(np.arange(len(blocks)), sizes), label)


def judge(docs: DataFrame, chain: Chain, text: str = "text", id_col: str = "doc_id", share: float = CONTENT_SHARE) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share`` and
    ``content`` (the numbers of the content lines, among those with a word) for every whole text.

    Null and empty texts have no words and fail. Rows are judged one by one, so repeated rows and null ids come out as they
    went in; other columns are not read. Lines that can be labelled either way count as content.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                count, lines = measure(*text_buffer(filled(part.column("text"))))
                label = viterbi(shared.value, lines["features"], lines["doc"])
                good = np.bincount(lines["doc"], lines["chars"] * label, part.num_rows)
                every = np.bincount(lines["doc"], lines["chars"], part.num_rows)
                ratio = good / np.maximum(every, 1)
                failed = (count["n_words"] < 50) | (100 * count["n_repeat_words"] > 50 * count["n_words"])
                line_of = np.arange(len(label)) - np.searchsorted(lines["doc"], lines["doc"], "left")
                own = np.searchsorted(lines["doc"][label == 1], np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(count[c].astype(np.int64)) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                     pa.array(failed), pa.array(~failed & (ratio >= share)), pa.array(ratio), pa.ListArray.from_arrays(pa.array(own), pa.array(line_of[label == 1].astype(np.int32)))],
                    ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share", "content"],
                )

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double, content array<int>"
    )
