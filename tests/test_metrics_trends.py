from __future__ import annotations

import math

import numpy as np
import pytest

from jobweave.operators import metrics, trends

TRUE = [1, 0, 1, 1, 0, 1, 0, 0, 1, 0]
PRED = [1, 0, 0, 1, 0, 1, 1, 0, 1, 1]


@pytest.fixture(scope="module")
def binary(spark):
    return spark.createDataFrame(list(zip(TRUE, PRED)), "y int, p int")


def test_binary_metrics(binary):
    row = metrics.classification_metrics(binary, "y", "p", "binary").first()
    assert (row["accuracy"], row["precision"], row["recall"]) == (pytest.approx(0.7), pytest.approx(4 / 6), pytest.approx(4 / 5))
    assert row["f1_score"] == pytest.approx(8 / 11)
    micro = metrics.classification_metrics(binary, "y", "p", "micro").first()
    assert micro["precision"] == micro["recall"] == pytest.approx(0.7)


def test_averages_over_classes_never_predicted(spark):
    frame = spark.createDataFrame([(0, 0), (1, 2), (2, 2), (2, 2)], "y int, p int")
    macro = metrics.classification_metrics(frame, "y", "p", "macro").first()
    assert macro["precision"] == pytest.approx((1 + 0 + 2 / 3) / 3)
    assert macro["recall"] == pytest.approx((1 + 0 + 1) / 3)
    weighted = metrics.classification_metrics(frame, "y", "p").first()
    assert weighted["recall"] == pytest.approx(0.75)
    report = {r["label"]: r for r in metrics.classification_report(frame, "y", "p").collect()}
    assert report["1"]["f1_score"] == 0.0 and report["2"]["support"] == 2 and report["macro avg"]["support"] == 4
    cells = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(frame, "y", "p").collect()}
    assert len(cells) == 9 and cells[(2, 2)] == 2 and cells[(0, 1)] == 0


def test_empty_input_is_an_error(spark, binary):
    empty = binary.limit(0)
    for fn in (metrics.classification_metrics, metrics.regression_metrics, metrics.r2_mae):
        with pytest.raises(Exception, match="no rows"):
            fn(empty, "y", "p").collect()
    with pytest.raises(ValueError):
        metrics.classification_metrics(binary, "y", "p", "samples")


def test_auc_with_ties_equals_pair_counting(spark):
    rng = np.random.default_rng(5)
    y, s = rng.integers(0, 2, 400), rng.integers(0, 40, 400) / 40
    frame = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :])).mean()
    assert metrics.roc_auc(frame, "y", "s", buckets=8).first()["auc"] == pytest.approx(want)
    assert metrics.roc_auc(frame.where("y = 1"), "y", "s").first()["auc"] is None


def test_regression_metrics(spark):
    y, p = [3.0, -0.5, 2.0, 7.0], [2.5, 0.0, 2.0, 8.0]
    frame = spark.createDataFrame(list(zip(y, p)), "y double, p double")
    row = metrics.regression_metrics(frame, "y", "p").first()
    assert (row["mse"], row["rmse"]) == (pytest.approx(0.375), pytest.approx(math.sqrt(0.375)))
    row = metrics.r2_mae(frame, "y", "p").first()
    assert (row["r2"], row["mae"]) == (pytest.approx(1 - 1.5 / 29.1875), pytest.approx(0.5))


def test_ranking_metrics(spark):
    recs = spark.createDataFrame(
        [("ann", ["k3", "k7", "k1", "k9"]), ("ben", ["m2", "m5", "m1", "m8", "m9", "m4"]), ("cyd", ["z"]), ("dov", ["q1", "q2"])],
        "user_id string, items array<string>",
    )
    actual = spark.createDataFrame(
        [("ann", ["k9", "k1"]), ("ben", ["m1", "m2", "m4", "m7", "m6"]), ("cyd", [])], "user_id string, items array<string>"
    )
    long_recs, long_actual = metrics.ranked_rows(recs, "user_id", "items"), metrics.ranked_rows(actual, "user_id", "items")
    row = metrics.ranking_metrics_at_k(long_recs, long_actual, (4,)).first()
    # ann: 2 hits of 4 places and of 2 wanted; ben: 2 of 4 and of 5; cyd wants nothing
    assert row["users"] == 3
    assert row["avg_precision"] == pytest.approx((2 / 4 + 2 / 4 + 0) / 3)
    assert row["avg_recall"] == pytest.approx((2 / 2 + 2 / 5 + 0) / 3)
    twice = spark.createDataFrame([("ben", ["m2", "m2"])], "user_id string, items array<string>")
    row = metrics.ranking_metrics_at_k(metrics.ranked_rows(twice, "user_id", "items"), long_actual, (8,)).first()
    assert row["avg_precision"] == pytest.approx(2 / 8)
    nobody = metrics.ranking_metrics_at_k(long_recs.limit(0), long_actual, (8,)).first()
    assert (nobody["users"], nobody["avg_precision"], nobody["avg_recall"]) == (0, 0.0, 0.0)


POSTINGS = [
    ("p-1", "2021-06-03", ["Rust", "kafka"]), ("p-2", "2021-06-28", ["figma", "RUST"]),
    ("p-3", "2021-08-11", ["kafka", "kafka", None]), ("p-4", "2021-08-30", None), ("p-5", None, ["x"]),
]


def test_skill_trends(spark):
    frame = spark.createDataFrame(POSTINGS, "job_id string, date_posted string, skills array<string>")
    rows = trends.posting_skills(frame, "skills", ["date_posted"])
    out = trends.skill_trends(rows, "date_posted")
    got = {(r["period"], r["skill"]): r["count"] for r in out.collect()}
    assert got == {("2021-06", "rust"): 2, ("2021-06", "kafka"): 1, ("2021-06", "figma"): 1, ("2021-08", "kafka"): 2}
    top = [r["skill"] for r in trends.first_period_top_skills(out, 3).collect()]
    assert top == ["rust", "figma", "kafka"]
    demand = {r["period"]: r["postings"] for r in trends.demand_trends(frame, "date_posted").collect()}
    assert demand == {"2021-06": 2, "2021-07": 0, "2021-08": 2}


def test_salary_aggregates(spark):
    rows = [("dev", "100"), ("dev", "300"), ("ops", "250"), ("ops", "n/a"), ("qa", "10")] + [("box", str(v)) for v in (1, 2, 3, 4, 100)]
    frame = spark.createDataFrame(rows, "title string, salary string")
    means = [(r["title"], r["avg_salary"]) for r in trends.avg_salary_by_title(frame, "title", "salary").collect()]
    assert means == [("ops", 250.0), ("dev", 200.0), ("box", 22.0), ("qa", 10.0)]
    boxes = {r["title"]: r for r in trends.salary_distribution(frame, "title", "salary").collect()}
    b = boxes["box"]
    assert (b["q1"], b["median"], b["q3"], b["whisker_low"], b["whisker_high"], b["outliers"]) == (2, 3, 4, 1, 4, 1)


def test_histogram_edges(spark):
    frame = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 10)], "s double")
    bins = {r["bin"]: r["n"] for r in trends.score_histogram(frame, "s", 5).collect()}
    assert bins == {0: 2, 1: 1, 2: 0, 3: 0, 4: 1}
    same = spark.createDataFrame([(0.3,)] * 4, "s double")
    bins = {r["bin"]: r["n"] for r in trends.score_histogram(same, "s", 20).collect()}
    assert bins[10] == 4 and sum(bins.values()) == 4 and len(bins) == 20


def test_density_equals_direct_sum(spark):
    values = [0.1, 0.1, 0.4, 0.7, 0.75]
    frame = spark.createDataFrame([(v,) for v in values], "s double")
    h = np.std(values, ddof=1) * len(values) ** -0.2
    for r in trends.score_density(frame, "s", 11).collect():
        want = sum(math.exp(-0.5 * ((r["x"] - v) / h) ** 2) for v in values) / (len(values) * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(want)
