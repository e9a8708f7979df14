"""The sparse tree against a dense one grown by trying every split of every term."""

from __future__ import annotations

import math
import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobweave.operators import models, slices, sparse_tree
from jobweave.session import shared_dir

WORDS = [f"w{i}" for i in range(30)]


def rows(n=160, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        label = rng.choice(["a", "b", "b", "c"])
        hint = {"a": WORDS[:6], "b": WORDS[4:12], "c": WORDS[10:16]}[label]
        words = rng.choices(WORDS, k=rng.randint(0, 8)) + rng.choices(hint, k=rng.randint(0, 3))
        out.append((i, " ".join(words), label))
    return out


def dense_bins(texts, train, numbers):
    """The bins of all terms of all texts, with document frequencies and lengths worked out in plain Python."""
    def grams(t):
        w = t.split()
        return w + [f"{x} {y}" for x, y in zip(w, w[1:])]

    n = sum(train)
    df = Counter(g for t, used in zip(texts, train, strict=True) if used for g in set(grams(t)))
    idf = {g: math.log((n + 1) / (d + 1)) + 1 for g, d in df.items() if 2 <= d <= 0.95 * n}
    assert set(idf) == set(numbers)
    terms = sorted(idf, key=numbers.get)
    out = np.zeros((len(texts), len(terms)), int)
    for i, t in enumerate(texts):
        raw = {g: c * idf[g] for g, c in Counter(grams(t)).items() if g in idf}
        length = math.sqrt(sum(v * v for v in raw.values()))
        for j, g in enumerate(terms):
            if g in raw:
                out[i, j] = min(32, max(1, math.ceil(32 + 4 * math.log2(raw[g] / length))))
    return out, terms


def dense_tree(x, y, weights, depth):
    """Nested (term, bin, left, right) or a leaf's counts; the largest gain, then the lower term, then the lower bin."""
    totals = np.bincount(y, minlength=len(weights))
    if depth == 0 or (totals > 0).sum() < 2:
        return tuple(totals)
    def purity(t):
        w = t * weights
        return (w * w).sum() / w.sum()
    best = None
    for j in range(x.shape[1]):
        for b in sorted(set(x[:, j]) - {0}):
            right = x[:, j] >= b
            if right.all():
                continue
            r = np.bincount(y[right], minlength=len(weights))
            gain = round((purity(r) + purity(totals - r) - purity(totals)) / (totals * weights).sum(), 12)
            if gain > 0 and (best is None or gain > best[0]):
                best = gain, j, b - 1
    if best is None:
        return tuple(totals)
    _, j, b = best
    right = x[:, j] > b
    return j, b, dense_tree(x[~right], y[~right], weights, depth - 1), dense_tree(x[right], y[right], weights, depth - 1)


def nested(tree, terms, node=0):
    if tree.right[node] < 0:
        return tuple(tree.totals[node])
    return terms.index(tree.number[node]), tree.at[node], nested(tree, terms, tree.left[node]), nested(tree, terms, tree.right[node])


@pytest.mark.parametrize("depth", [1, 3, 30])
def test_equals_the_dense_tree(spark, depth):
    data = [(*r, r[0] % 5 != 0) for r in rows()]
    frame = spark.createDataFrame(data, "id long, text string, topic string, is_train boolean").repartition(5)
    model, scored = sparse_tree.fit_text_tree(frame, "id", "text", "topic", "is_train", [], depth)
    numbers = {r["term"]: r["number"] for r in model.vocabulary.collect()}
    x, terms = dense_bins([r[1] for r in data], [r[3] for r in data], numbers)
    train = np.array([r[3] for r in data])
    y = np.array(["abc".index(r[2]) for r in data])
    count = np.bincount(y[train])
    weights = train.sum() / (3 * count)
    want = dense_tree(x[train], y[train], weights, depth)
    assert nested(model.tree, [numbers[t] for t in terms]) == want

    def leaf(node, row):
        while len(node) == 4:
            node = node[3] if row[node[0]] > node[1] else node[2]
        return "abc"[int(np.argmax(np.array(node) * weights))]

    expected = {r[0]: leaf(want, x[i]) for i, r in enumerate(data)} if len(want) == 4 else {}
    assert {r["id"]: r["predicted_category"] for r in scored.collect()} == expected
    assert {r["id"]: r["predicted_category"] for r in model.transform(frame).collect()} == expected


def test_many_slices_count_as_one(spark, monkeypatch):
    frame = spark.createDataFrame([(*r, True) for r in rows(80, 5)], "id long, text string, topic string, is_train boolean").repartition(3)
    one, _ = sparse_tree.fit_text_tree(frame, "id", "text", "topic", "is_train", [])
    monkeypatch.setattr(sparse_tree, "CHUNK", 20)
    monkeypatch.setattr(sparse_tree, "CELLS", 200)
    two, _ = sparse_tree.fit_text_tree(frame, "id", "text", "topic", "is_train", [])
    assert one.tree == two.tree


def test_odd_texts(spark, new_dir):
    frame = spark.createDataFrame(rows(100), "id long, text string, topic string")
    trained = models.train_job_classifier(frame, "id", "text", "topic", stop_words=[], path=f"{new_dir}/m")
    odd = spark.createDataFrame([(1, None), (1, None), (None, "w1 w2"), (2, "unknown"), (2, ""), (3, "w1 " * 5000)], "id long, text string")
    found = models.predict_job_category(odd, path=f"{new_dir}/m")
    assert found.count() == 6 and {r["predicted_category"] for r in found.collect()} <= {"a", "b", "c"}
    assert len({r["predicted_category"] for r in found.where(F.col("text").isNull() | (F.col("text").isin("", "unknown"))).collect()}) == 1
    assert trained.metrics["rows"] == 100


def test_a_split_is_worth_nothing_where_all_texts_are_alike(spark):
    frame = spark.createDataFrame([(i, "same words here", "ab"[i % 2]) for i in range(40)], "id long, text string, topic string")
    trained = models.train_job_classifier(frame, "id", "text", "topic", stop_words=[])
    assert trained.model.tree.right == [-1]


def test_slices_and_buckets_do_not_change_the_tree(spark, monkeypatch):
    """Terms are counted by slices of texts and judged by buckets of terms: many of both give the same tree and the same classes."""
    frame = spark.createDataFrame(rows(), "id long, text string, topic string").withColumn("is_train", F.col("id") % 4 != 0)
    found = []
    for slice_bytes, bucket in ((1 << 23, 1 << 21), (500, 40)):
        monkeypatch.setattr("jobweave.operators.slices.SLICE_BYTES", slice_bytes)
        monkeypatch.setattr(sparse_tree, "BUCKET", bucket)
        model, scored = sparse_tree.fit_text_tree(frame, "id", "text", "topic", "is_train", [], 4)
        found.append((vars(model.tree), sorted(map(tuple, scored.collect()))))
    assert found[0] == found[1] and len(found[0][0]["number"]) > 3


def test_a_fit_leaves_only_what_its_model_and_scores_read(spark):
    """Words, terms and counts of the slices are removed, and numbers that slices work out are those of the vocabulary."""
    shared = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    frame = spark.createDataFrame(rows(90, 8), "id long, text string, topic string")
    trained = models.train_job_classifier(frame, "id", "text", "topic", stop_words=[])
    assert sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(shared)) - before) == ["tree-rows", "vocabulary"]
    assert trained.tables["test"].count() > 10
    words = ["a", "ab cd", "x" * 31, "x" * 32, "é" * 40, "long " * 30, "1234567", "12345678 9"]
    hashed = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64(F.lit(3), "w").alias("h")).collect()
    start = spark.range(1).select(F.xxhash64(F.lit(3))).first()[0]
    assert slices.term_numbers(pa.array([r["w"] for r in hashed]), start).tolist() == [r["h"] for r in hashed]
