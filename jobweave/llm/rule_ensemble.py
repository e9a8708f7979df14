"""Quality classifier: a sparse rule ensemble over text statistics.

Every whole text is measured by some statistics. A forest of small trees is grown on labelled documents; every path from a root to a node is a
rule, a conjunction of bounds on statistics. A logistic model with lasso penalty weighs the distinct rules, most get no weight. The rules that are
left are compiled into one Spark column expression over the statistics, which scores all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import SLICE_BYTES, filled, mix, slices, text_buffer, word_hashes, words_of, written

#: Labelled documents that the model is fitted on at most, about; chosen by a hash of the id.
SAMPLE_DOCS = 8000
TREES, DEPTH, SEED = 30, 4, 7
#: Weight of the lasso penalty beside the mean log loss.
PENALTY = 0.002
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>{}[]\\^~_=+@", np.uint8))
#: Bytes behind which a long text may be cut: line ends before blanks.
LINE_END, BLANK = 10, 32
STATISTICS = [
    "log_words", "mean_word", "long_words", "symbol_share", "symbol_words", "capital_share", "digit_share", "bang_share", "stop_share", "comma_share", "other_script",
    "distinct_words", "repeated_runs", "twin_words", "repeated_lines", "log_line", "closed_lines",
]


@dataclass(frozen=True)
class Rule:
    """Bounds on statistics, as ``(statistic, above, at most)``; it holds where all do."""

    bounds: tuple[tuple[int, float, float], ...]

    def column(self) -> Column:
        parts = []
        for number, low, high in self.bounds:
            value = F.col(STATISTICS[number])
            parts += [value > F.lit(low)] * (low > -inf) + [value <= F.lit(high)] * (high < inf)
        return reduce(lambda a, b: a & b, parts)

    def holds(self, values: np.ndarray) -> np.ndarray:
        """The same for an array of statistics, row by row."""
        return np.all([(values[:, n] > low) & (values[:, n] <= high) for n, low, high in self.bounds], axis=0)


@dataclass
class Ensemble:
    """Rules with weights, and the log odds without any rule."""

    intercept: float
    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def score(self) -> Column:
        """The probability of a good text, as an expression over the statistics' columns."""
        odds = F.lit(float(self.intercept))
        for rule, weight in zip(self.rules, self.weights, strict=True):
            odds = odds + F.when(rule.column(), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


# --- statistics ---------------------------------------------------------------------------


def _cuts(data: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of about ``most`` bytes that end behind a line's end, or else behind a blank, or else anywhere."""
    at = 0
    while at < len(data):
        to = min(at + most, len(data))
        if to < len(data):
            ends = np.flatnonzero(data[at:to] == LINE_END)
            ends = ends if len(ends) else np.flatnonzero(data[at:to] == BLANK)
            to = at + int(ends[-1]) + 1 if len(ends) else to
        yield at, to
        at = to


def _tally(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sums of each row, and hashes of its words and lines with the bounds of rows among them."""
    rows = len(bounds) - 1
    starts, ends, words = words_of(data, bounds)
    size = ends - starts
    row = np.repeat(np.arange(rows), np.diff(words))

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(mask)]
        return total[bounds[1:]] - total[bounds[:-1]]

    symbol = np.r_[0, np.cumsum(SYMBOLS[data])]
    head = np.unique(np.r_[bounds[:-1], np.flatnonzero(data == LINE_END) + 1])
    head = head[head < len(data)]
    tail = np.r_[head[1:], len(data)] if len(head) else head
    tail = tail - (data[tail - 1] == LINE_END) if len(head) else tail
    full = np.searchsorted(starts, tail) > np.searchsorted(starts, head)
    head, tail = head[full], tail[full]
    line_row = np.searchsorted(bounds, head, "right") - 1
    closed = np.isin(data[tail - 1], np.frombuffer(b".!?", np.uint8)) if len(tail) else np.zeros(0, bool)
    sums = np.stack([
        np.diff(words), np.bincount(row, size, rows), np.bincount(row[size > 12], minlength=rows), share(SYMBOLS[data]),
        np.bincount(row, (symbol[ends] > symbol[starts]) if len(starts) else None, rows), share((data >= 65) & (data <= 90)),
        share((data >= 48) & (data <= 57)), share((data == 33) | (data == 63)), share(data == 46), share(data == 44), share(data >= 128),
        np.bincount(line_row, minlength=rows), np.bincount(line_row, tail - head, rows), np.bincount(line_row, closed, rows),
    ], axis=1).astype(float)
    return sums, word_hashes(data, starts, ends), words, word_hashes(data, head, tail), np.searchsorted(line_row, np.arange(rows + 1))


def _repeats(keys: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """For each row the number of keys that the row has had before."""
    own = mix(keys + row.astype(np.uint64) * np.uint64(0x165667B19E3779F9))
    order = np.argsort(own, kind="stable")
    again = np.r_[False, own[order[1:]] == own[order[:-1]]] if len(own) else np.zeros(0, bool)
    return np.bincount(row[order[again]], minlength=rows)


def measure(data: np.ndarray, bounds: np.ndarray, most: int = SLICE_BYTES) -> np.ndarray:
    """The statistics of each row of a run of texts. A single text beyond ``most`` bytes is taken in parts of whole lines or words; a line cut so counts as two."""
    rows = len(bounds) - 1
    parts = [(0, len(data))] if rows != 1 or len(data) <= most else list(_cuts(data, most))
    tallies = [_tally(data[a:b], bounds if len(parts) == 1 else np.array([0, b - a])) for a, b in parts] or [_tally(data, bounds)]
    sums = sum(t[0] for t in tallies)
    hashes, lines = np.concatenate([t[1] for t in tallies]), np.concatenate([t[3] for t in tallies])
    row = np.repeat(np.arange(rows), sums[:, 0].astype(np.int64))
    line_row = np.repeat(np.arange(rows), sums[:, 11].astype(np.int64))
    words, n_lines, size = np.maximum(sums[:, 0], 1), np.maximum(sums[:, 11], 1), np.maximum(sums[:, 1], 1)
    runs = np.zeros(0, np.uint64)
    run_row = row[2:][row[2:] == row[:-2]]
    if len(hashes) > 2:
        first = np.flatnonzero(row[2:] == row[:-2])
        runs = mix(hashes[first] * np.uint64(0x9E3779B97F4A7C15) + hashes[first + 1] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[first + 2])
    twins = np.flatnonzero((hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])) if len(hashes) > 1 else np.zeros(0, np.int64)
    columns = [
        np.log1p(sums[:, 0]), sums[:, 1] / words, sums[:, 2] / words, sums[:, 3] / size, sums[:, 4] / words, sums[:, 5] / size, sums[:, 6] / size, sums[:, 7] / words,
        sums[:, 8] / words, sums[:, 9] / words, sums[:, 10] / size, 1 - _repeats(hashes, row, rows) / words, _repeats(runs, run_row, rows) / words,
        np.bincount(row[twins], minlength=rows) / words, _repeats(lines, line_row, rows) / n_lines, np.log1p(sums[:, 12] / n_lines), sums[:, 13] / n_lines,
    ]
    return np.stack(columns, axis=1)


def statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``keep`` and one double column per statistic, of every whole text; null reads as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = measure(*text_buffer(filled(part.column("text"))))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(np.ascontiguousarray(c)) for c in found.T)], [*keep, *STATISTICS])

    source = docs.select(*keep, F.col(text).cast("string").alias("text"))
    kinds = [f"{c} {source.schema[c].dataType.simpleString()}" for c in keep]
    return source.mapInArrow(run, ", ".join([*kinds, *(f"{c} double" for c in STATISTICS)]))


# --- rules --------------------------------------------------------------------------------


def tree_rules(root: object) -> set[Rule]:
    """The rules of a fitted tree (a node of the JVM's): one for each node below the root, its path's bounds drawn together per statistic."""
    found: set[Rule] = set()
    open_nodes: list[tuple[object, dict[int, tuple[float, float]]]] = [(root, {})]
    while open_nodes:
        node, bounds = open_nodes.pop()
        if bounds:
            found.add(Rule(tuple((n, *bounds[n]) for n in sorted(bounds))))
        if not node.subtreeDepth():
            continue
        number, at = node.split().featureIndex(), node.split().threshold()
        low, high = bounds.get(number, (-inf, inf))
        open_nodes.append((node.leftChild(), bounds | {number: (low, min(high, at))}))
        open_nodes.append((node.rightChild(), bounds | {number: (max(low, at), high)}))
    return found


def fit_rules(measured: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> Ensemble:
    """The ensemble of rows with statistics and ``label`` (0 or 1). With one label only, its share alone is the score; without rows, a half."""
    counts = {r["label"]: r["count"] for r in measured.groupBy("label").count().collect()}
    good, every = counts.get(1, 0), sum(counts.values())
    if not 0 < good < every:
        return Ensemble(float(np.log((good + 0.5) / (every - good + 0.5))))
    vectors = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(measured).select("features", F.col("label").cast("double").alias("label"), *STATISTICS)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, minInstancesPerNode=5, seed=SEED, featureSubsetStrategy="onethird").fit(vectors)
    rules = sorted(set().union(*(tree_rules(tree._call_java("rootNode")) for tree in forest.trees)), key=lambda r: r.bounds)
    if not rules:
        return Ensemble(float(np.log(good / (every - good))))
    held = vectors.select("label", F.array(*[r.column().cast("double") for r in rules]).alias("held"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=100).fit(held.select("label", array_to_vector("held").alias("features")))
    weights = lasso.coefficients.toArray()
    used = np.flatnonzero(weights)
    return Ensemble(float(lasso.intercept), [rules[i] for i in used], [float(weights[i]) for i in used])


def training_fold(id_col: str = "doc_id") -> Column:
    """Rows whose labels may be learned from; the others are held out. A null id is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 != 1, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", quality: str = "quality", sample_docs: int = SAMPLE_DOCS) -> Ensemble:
    """The ensemble of about ``sample_docs`` labelled documents of the training fold at most, whole texts.

    Rows with a null label, id or text are passed over. An id with several labels counts as good if one of them is 1.
    """
    known = labels.where(F.col(quality).isNotNull() & F.col(id_col).isNotNull() & training_fold(id_col)).select(F.col(id_col).alias("_id"), F.col(quality).cast("int").alias("label"))
    share = min(1.0, sample_docs / max(1, known.count()))
    some = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(share * (1 << 30))).groupBy("_id").agg(F.max("label").alias("label"))
    # the sample's size is bounded by its parameter, so it may be sent to every task
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("text")).join(F.broadcast(some), "_id").where(F.col("text").isNotNull())
    return fit_rules(written(statistics(rows, "text", ("label",)), "rule-sample"))


def classify(docs: DataFrame, ensemble: Ensemble, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the statistics of every whole text.

    Empty and null texts are scored by statistics of nothing. Rows are taken one by one, so repeated rows and null ids (never held out) come out as
    they went in; other columns, labels among them, are not read.
    """
    measured = statistics(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), "text", ("doc_id",))
    scored = measured.withColumn("score", ensemble.score())
    return scored.select("doc_id", (~training_fold("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *STATISTICS)
