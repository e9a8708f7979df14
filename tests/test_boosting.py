"""Boosting against a plain NumPy version over single rows, with its early stopping."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobweave.operators import boosting, models


def data(n=300, seed=2, noise=5.0):
    rng = np.random.default_rng(seed)
    years, size = rng.integers(1, 9, n).astype(float), np.round(rng.random(n) * 4, 1)
    place = rng.choice(["Austin", "Boston", "Remote", "Zurich"], n)
    pay = 20 * years + 30 * (place == "Zurich") + 8 * size * (place == "Remote") + noise * rng.normal(size=n)
    watch = rng.random(n) < 0.25
    return years, size, place, pay, watch


def plain_boosting(years, size, place, pay, watch, rounds, rate=0.1, depth=5, patience=10):
    """Predictions for all rows, rounds run and rounds kept; splits over one-hot and raw values of the single rows."""
    learn = ~watch
    base = pay[learn].mean()
    cuts = [sorted(set(c[learn])) for c in (years, size)]
    levels = sorted(set(place[learn]))
    pred, history, errors = np.zeros(len(pay)), [], []
    worth = lambda g, n: g * g / (n + 1.0)

    def grow(rows, every, left_depth):
        g, n = (pred[rows] - (pay[rows] - base)).sum(), len(rows)
        best = None
        if left_depth:
            tried = [(f, c, (years, size)[f] > c) for f in (0, 1) for c in cuts[f]] + [(2, c, place == c) for c in levels]
            for f, c, mask in tried:
                right = rows[mask[rows]]
                if 0 < len(right) < n:
                    gr = (pred[right] - (pay[right] - base)).sum()
                    gain = round(worth(gr, len(right)) + worth(g - gr, n - len(right)) - worth(g, n), 6)
                    if gain > 1e-6 and (best is None or gain > best[0]):
                        best = gain, mask
        if best is None:
            step[every] = -rate * g / (n + 1.0)
            return
        grow(rows[best[1][rows]], every[best[1][every]], left_depth - 1)
        grow(rows[~best[1][rows]], every[~best[1][every]], left_depth - 1)

    for _ in range(rounds + 1):
        errors.append(np.sqrt((((pay - base) - pred)[watch] ** 2).mean()))
        if len(errors) - 1 - int(np.argmin(errors)) >= patience or len(history) == rounds:
            break
        step = np.zeros(len(pay))
        grow(np.flatnonzero(learn), np.arange(len(pay)), depth)
        pred = pred + step
        history.append(step)
    kept = int(np.argmin(errors))
    return base + sum(history[:kept], np.zeros(len(pay))), len(history), kept


def frame(spark, years, size, place, pay, watch):
    rows = [(i, float(a), float(b), str(c), float(d), bool(e)) for i, (a, b, c, d, e) in enumerate(zip(years, size, place, pay, watch, strict=True))]
    return spark.createDataFrame(rows, "id long, years double, size double, place string, pay double, watch boolean").repartition(3)


@pytest.mark.parametrize("rounds,noise,few", [(4, 5.0, 0), (4, 5.0, 4096), (60, 60.0, 4096)])
def test_equals_the_plain_version(spark, rounds, noise, few, monkeypatch):
    monkeypatch.setattr(boosting, "FEW_LEVELS", few)
    columns = data(noise=noise)
    want, run, kept = plain_boosting(*columns, rounds)
    rows = frame(spark, *columns)
    model, found = boosting.fit_boosted_trees(rows, "pay", ["years", "size"], ["place"], "watch", rounds=rounds)
    assert (found["rounds_run"], found["rounds_kept"]) == (run, kept)
    got = {r["id"]: r["prediction"] for r in model.transform(rows).collect()}
    assert np.allclose([got[i] for i in range(len(want))], want, rtol=1e-9)
    if rounds == 60:
        assert kept < run == kept + 10


def test_unknown_and_missing_inputs(spark, new_dir):
    rows = frame(spark, *data())
    model, found = boosting.fit_boosted_trees(rows, "pay", ["years"], ["place"], rounds=12)
    assert found == {"rounds_run": 12.0, "rounds_kept": 12.0}
    odd = spark.createDataFrame([(1, None, "Austin"), (2, 3.0, None), (3, 3.0, "Nowhere"), (4, 100.0, "Zurich")], "id long, years double, place string")
    before = model.transform(odd).collect()
    assert all(r["prediction"] is not None for r in before) and before[1]["prediction"] == before[2]["prediction"]
    model.save(spark, new_dir + "/m")
    assert boosting.BoostedTrees.load(spark, new_dir + "/m").transform(odd).collect() == before
    with pytest.raises(FileNotFoundError):
        boosting.BoostedTrees.load(spark, new_dir + "/none")
    only_numbers, _ = boosting.fit_boosted_trees(rows, "pay", ["years", "size"], [], "watch", rounds=3)
    only_levels, _ = boosting.fit_boosted_trees(rows, "pay", [], ["place"], "watch", rounds=3)
    for m in (only_numbers, only_levels):
        assert m.transform(rows).agg(F.stddev("prediction")).first()[0] > 0


def test_many_levels_and_values(spark):
    """Two thousand levels, of which each row has one, and a number with more values than bins."""
    rng = np.random.default_rng(4)
    n = 6000
    level, x = rng.integers(0, 2000, n), rng.random(n)
    rows = [(i, f"job{v:06d}", float(a), float(100 * (v == 7) + 50 * a + (5 if v % 2 else 0)), i % 5 == 0) for i, (v, a) in enumerate(zip(level, x, strict=True))]
    table = spark.createDataFrame(rows, "id long, job string, x double, pay double, watch boolean")
    model, found = boosting.fit_boosted_trees(table, "pay", ["x"], ["job"], "watch", rounds=8)
    assert len(model.cuts[0]) <= 256 and found["watch_rmse"] < table.agg(F.stddev("pay")).first()[0]


def test_salary_model_stops_and_reports(spark, new_dir):
    years, size, place, pay, _ = data(400, 8, 80.0)
    table = spark.createDataFrame([(i, str(p), int(y), float(v)) for i, (y, p, v) in enumerate(zip(years, place, pay, strict=True))], "id long, location string, experience_numeric int, salary_midpoint double")
    trained = models.train_salary_forecaster(table, "id", path=new_dir + "/salary")
    assert trained.metrics["rounds_kept"] <= trained.metrics["rounds_run"] <= 100
    one, two = (models.predict_salary(table, **k).orderBy("id").collect() for k in ({"model": trained.model}, {"path": new_dir + "/salary"}))
    assert one == two
