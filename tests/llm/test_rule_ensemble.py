"""The rule ensemble: statistics against plain counts, compiled rules against arrays, lasso conditions, held-out accuracy."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from conftest import SF_DIR
from llm.brute import WORD

from jobweave.llm import rule_ensemble
from jobweave.llm.rule_ensemble import STATISTICS, Ensemble, Rule


def plain_statistics(text):
    raw = text.encode()
    words = [w.encode() for w in WORD.findall(text)]
    lines = [x.encode() for x in text.split("\n") if WORD.search(x)]
    n, size, n_lines = max(len(words), 1), max(sum(map(len, words)), 1), max(len(lines), 1)
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    symbols = rb"[#*$%&|<>{}\[\]\\^~_=+@]"
    return [
        np.log1p(len(words)), sum(map(len, words)) / n, sum(len(w) > 12 for w in words) / n, len(re.findall(symbols, raw)) / size, sum(bool(re.search(symbols, w)) for w in words) / n,
        len(re.findall(rb"[A-Z]", raw)) / size, len(re.findall(rb"[0-9]", raw)) / size, len(re.findall(rb"[!?]", raw)) / n, raw.count(b".") / n, raw.count(b",") / n, sum(b >= 128 for b in raw) / size,
        1 - (len(words) - len(set(words))) / n, (len(runs) - len(set(runs))) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
        (len(lines) - len(set(lines))) / n_lines, np.log1p(sum(map(len, lines)) / n_lines), sum(x[-1:] in (b".", b"!", b"?") for x in lines) / n_lines,
    ]


def test_statistics(docs, texts):
    found = {r["doc_id"]: [r[c] for c in STATISTICS] for r in rule_ensemble.statistics(docs, "text", ("doc_id",)).collect()}
    for i, text in texts:
        assert found[i] == pytest.approx(plain_statistics(text or ""), abs=1e-9), i


def test_long_texts_are_measured_in_parts():
    rng = np.random.default_rng(1)
    text = "\n".join(" ".join(rng.choice(["ab", "c!", "DE", "é", "f."], 9)) for _ in range(400))
    data = np.frombuffer(text.encode(), np.uint8)
    whole, parts = (rule_ensemble.measure(data, np.array([0, len(data)]), most)[0] for most in (1 << 20, 500))
    assert whole == pytest.approx(parts, abs=1e-12) and whole == pytest.approx(plain_statistics(text), abs=1e-9)
    rule_ensemble.measure(np.full(5000, 120, np.uint8), np.array([0, 5000]), 500)


def test_compiled_rules_equal_arrays(spark, docs):
    rules = [Rule(((0, 1.0, 4.5),)), Rule(((1, -np.inf, 5.0), (11, 0.5, np.inf))), Rule(((3, 0.0, np.inf),))]
    model = Ensemble(0.3, rules, [1.5, -2.0, 0.25])
    rows = rule_ensemble.classify(docs, model).collect()
    values = np.array([[r[c] for c in STATISTICS] for r in rows])
    odds = 0.3 + sum(w * r.holds(values) for r, w in zip(rules, model.weights, strict=True))
    assert np.allclose([r["score"] for r in rows], 1 / (1 + np.exp(-odds)), rtol=1e-12)
    assert all(r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)


def measured(spark, rows=600, seed=3):
    rng = np.random.default_rng(seed)
    values = rng.random((rows, len(STATISTICS)))
    label = ((values[:, 2] > 0.4) & (values[:, 5] <= 0.7)).astype(int)
    return spark.createDataFrame([(*map(float, v), int(y)) for v, y in zip(values, label, strict=True)], [*STATISTICS, "label"]), values, label


def test_rules_are_paths_and_weights_are_the_lasso(spark):
    frame, values, label = measured(spark)
    model = rule_ensemble.fit_rules(frame, trees=8, depth=3, penalty=0.01)
    assert 0 < len(model.rules) and all(len(r.bounds) <= 3 for r in model.rules) and len(set(model.rules)) == len(model.rules)
    held = np.stack([r.holds(values) for r in model.rules], axis=1).astype(float)
    weights = np.array(model.weights)
    chance = 1 / (1 + np.exp(-(model.intercept + held @ weights)))
    assert np.mean((chance >= 0.5) == label) > 0.97
    # at the optimum the loss falls along each weighted rule as fast as the penalty (on unit deviation) grows
    slope = held.T @ (chance - label) / len(label)
    penalty = 0.01 * held.std(axis=0, ddof=1)
    assert np.allclose(slope, -np.sign(weights) * penalty, atol=3e-4) and abs(np.mean(chance - label)) < 1e-4


def test_sparse(spark):
    frame, _, _ = measured(spark)
    few, many = (len(rule_ensemble.fit_rules(frame, trees=8, depth=3, penalty=p).rules) for p in (0.05, 0.0005))
    assert 0 < few < many


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    rows = rule_ensemble.classify(docs, rule_ensemble.fit(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    bad = [r for r in rows if r["quality"] == 0]
    good = [r for r in rows if r["quality"] == 1]
    assert len(rows) > 100 and np.mean([r["predicted"] for r in good]) > 0.98 and np.mean([1 - r["predicted"] for r in bad]) > 0.9


def test_held_out_labels_are_not_read(spark, docs):
    rows = [(i, int(i % 2 == 0), 0) for i in range(0, 200, 3)]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, 1 - t) for i, q, t in rows]
    one, two = (rule_ensemble.fit(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (rows, turned))
    assert one == two


def test_odd_rows(spark, docs, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (3, None), (None, 1), (6, 0), (6, 1), (9, 0)], "doc_id long, quality int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = rule_ensemble.fit(docs, labels)
    rows = rule_ensemble.classify(odd_docs, model).collect()
    assert sorted((r["doc_id"] or 0, r["held_out"]) for r in rows) == sorted((i, i > 0 and zlib.crc32(str(i).encode()) % 3 == 1) for i in (0, 0, 1, 1, 2))
    assert rule_ensemble.classify(no_docs, model).collect() == []
    assert {r["score"] for r in rule_ensemble.classify(docs, rule_ensemble.fit(docs, none)).collect()} == {0.5}
    only = rule_ensemble.fit(docs, labels.where("quality = 1"))
    assert not only.rules and {r["predicted"] for r in rule_ensemble.classify(docs, only).collect()} == {1}
